from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeweir.functions.records import to_records
from lakeweir.plans.topic_jobs import (
    bounded_read,
    copy_differences,
    differing_ranges,
    lines_to_topic,
    mirror_topics,
    publish_table,
    topic_offsets,
    topic_to_lines,
)
from lakeweir.schemas import TOPIC
from lakeweir.session import scratch_path
from lakeweir.sources.topics import ParquetTopics, within
from tests.helpers import plan_of


@pytest.fixture
def topics(spark):
    return ParquetTopics(scratch_path(spark, "topics"))


def test_offsets_count_up_in_every_partition(spark, topics):
    publish_table(spark.range(1000), topics, "t", partitions=7)
    stored = topics.read(spark, "t")
    assert stored.schema.fieldNames() == TOPIC.fieldNames()
    assert stored.count() == stored.select("partition", "offset").distinct().count() == 1000
    for r in topic_offsets(stored).collect():
        n = stored.filter(F.col("partition") == r["partition"]).count()
        assert (r["start_offset"], r["end_offset"]) == (0, n)


def test_later_writes_have_higher_offsets_and_repeats_replace(spark, topics):
    for sequence in (0, 1, 1):
        publish_table(spark.range(10), topics, "t", sequence=sequence)
    stored = topics.read(spark, "t")
    assert stored.count() == 20
    assert stored.select("partition", "offset").distinct().count() == 20
    assert stored.filter(F.col("offset") >= 1 << 33).count() == 10


def test_no_shuffle_unless_asked(spark):
    assert "Exchange" not in plan_of(to_records(spark.range(10)))


def test_bounds(spark, topics):
    publish_table(spark.range(100), topics, "t", partitions=2)
    found = bounded_read(spark, topics, "t", {0: 10, 1: 0}, {0: 20, 1: 5})
    assert found.groupBy("partition").count().orderBy("partition").collect() == [(0, 10), (1, 5)]
    assert bounded_read(spark, topics, "t", start={1: 45}).count() == 5
    assert bounded_read(spark, topics, "t", max_messages=7).count() == 7
    assert bounded_read(spark, topics, "t").count() == 100


def test_bounds_reach_the_scan(spark, topics):
    publish_table(spark.range(10), topics, "t")
    plan = plan_of(topics.read(spark, "t", {0: 3}, {0: 5}))
    assert "GreaterThanOrEqual(offset,3)" in plan and "LessThan(offset,5)" in plan
    assert topics.read(spark, "t").filter(within(None, None)).count() == 10


def test_mirror_copies_key_and_value_and_skips_what_came_from_there(spark, topics):
    rows = [("k1", "v1", "a.x"), (None, "v2", "a.x"), ("k3", None, "a.y"),
            ("k4", "v4", "other"), ("k5", "v5", "B.a.z"), ("k6", "v6", "C.B.a.z")]
    topics.write(spark.createDataFrame(rows, "key string, value string, topic string"))
    target = ParquetTopics(scratch_path(spark, "target"))
    mirror_topics(spark, topics, target, "A", scratch_path(spark, "cp"),
                  pattern=r"(.*\.)?a\..*", target_alias="B", trigger=None)
    copied = spark.read.schema(TOPIC).parquet(target.root)
    found = {(r["topic"], r["key"] and bytes(r["key"]).decode(),
              r["value"] and bytes(r["value"]).decode()) for r in copied.collect()}
    assert found == {("A.a.x", "k1", "v1"), ("A.a.x", None, "v2"), ("A.a.y", "k3", None)}


def test_mirror_goes_on_from_its_checkpoint(spark, topics):
    target, checkpoint = ParquetTopics(scratch_path(spark, "target")), scratch_path(spark, "cp")
    for sequence, value in enumerate(("one", "two")):
        topics.write(spark.createDataFrame([(value,)], "value string"), "t", sequence)
        mirror_topics(spark, topics, target, "A", checkpoint, trigger=None)
    values = [bytes(r["value"]) for r in target.read(spark, "A.t").collect()]
    assert sorted(values) == [b"one", b"two"]


def test_lines_in_and_out(spark, topics, tmp_path):
    (tmp_path / "in").mkdir()
    text = "first\n\n  spaced \r kept\nlast"
    (tmp_path / "in" / "a.txt").write_bytes(text.encode())
    lines_to_topic(spark, str(tmp_path / "in"), topics, "l", scratch_path(spark, "cp"), trigger=None)
    stored = topics.read(spark, "l").orderBy("partition", "offset").collect()
    assert [bytes(r["value"]).decode() for r in stored] == text.split("\n")
    out, checkpoint = str(tmp_path / "out"), scratch_path(spark, "cp")
    for _ in range(2):
        assert topic_to_lines(spark, topics, "l", out, checkpoint)
    lines = spark.read.option("lineSep", "\n").text(out).collect()
    assert sorted(r["value"] for r in lines) == sorted(text.split("\n"))


def test_copies_compared(spark):
    def log(rows):
        return spark.createDataFrame(
            rows, "topic string, partition int, offset long, key binary, value binary")

    left = log([("t", 0, 0, None, b"a"), ("t", 0, 1, b"k", b"b"), ("t", 0, 2, b"k", b"c"),
                ("t", 1, 0, None, None)])
    right = log([("t", 0, 0, None, b"a"), ("t", 0, 1, b"k", b"B"), ("t", 1, 0, None, None),
                 ("u", 0, 0, None, b"z")])
    assert sorted(copy_differences(left, right).collect()) == [
        ("t", 0, 1, "differs"), ("t", 0, 2, "only_left"), ("u", 0, 0, "only_right")]
    assert copy_differences(left, left).count() == 0


LOG = "topic string, partition int, offset bigint, key binary, value binary"


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_only_differing_ranges_are_compared(spark, limit):
    left = spark.range(20_000).select(
        F.lit("t").alias("topic"), (F.col("id") % 3).cast("int").alias("partition"),
        F.floor(F.col("id") / 3).alias("offset"), F.lit(None).cast("binary").alias("key"),
        F.col("id").cast("string").cast("binary").alias("value"))
    gone = (F.col("partition") == 1) & (F.col("offset") == 250)
    right = left.filter(~gone).repartition(5, "offset")
    assert differing_ranges(left, right, 100).collect() == [("t", 1, 2)]
    assert differing_ranges(left, left.repartition(3, "value"), 100).isEmpty()
    found = copy_differences(left, right, 100, limit)
    assert found.collect() == [("t", 1, 250, "only_left")]
    if limit:
        assert "BroadcastHashJoin LeftSemi" in plan_of(found)
    for line in plan_of(found).splitlines():
        if line.startswith("Arguments: hashpartitioning"):
            assert "value" not in line


def test_copies_without_places_and_with_repeats(spark):
    left = spark.createDataFrame(
        [(None, 0, 1, None, b"a"), ("t", None, 1, None, b"a"), ("t", 0, None, None, b"a"),
         ("t", 0, 7, None, b"x"), ("t", 0, 7, None, b"x")], LOG)
    missing = [(None, 0, 1), ("t", None, 1), ("t", 0, None)]
    found = sorted(copy_differences(left, left).collect(), key=str)
    assert found == sorted(((*m, s) for m in missing for s in ("only_left", "only_right")), key=str)
    once = left.filter("offset = 7").dropDuplicates()
    assert differing_ranges(left.filter("offset = 7"), once).count() == 1
    empty = left.limit(0)
    assert copy_differences(empty, empty).isEmpty()
    assert copy_differences(once, empty).collect() == [("t", 0, 7, "only_left")]


def test_copies_that_differ_by_a_moved_null(spark):
    schema = "topic string, partition int, offset bigint, key string, value string"
    left = spark.createDataFrame([("t", 0, 0, None, "x")], schema)
    right = spark.createDataFrame([("t", 0, 0, "x", None)], schema)
    assert [r["status"] for r in copy_differences(left, right).collect()] == ["differs"]


def test_bounded_read_takes_the_first_messages(spark, tmp_path):
    topics = ParquetTopics(str(tmp_path))
    publish_table(spark.range(300), topics, "t", partitions=4)
    taken = [(r["partition"], r["offset"]) for r in bounded_read(spark, topics, "t", max_messages=9).collect()]
    every = sorted((r["partition"], r["offset"]) for r in bounded_read(spark, topics, "t").collect())
    assert sorted(taken) == every[:9]


def test_offsets_of_stored_topics_read_no_messages(spark, topics):
    for name, rows in (("a", 5), ("b", 8)):
        publish_table(spark.range(rows).coalesce(1), topics, name)
    offsets = topic_offsets(topics.read_all(spark))
    assert sorted(map(tuple, offsets.collect())) == [("a", 0, 0, 5), ("b", 0, 0, 8)]
    assert "ReadSchema: struct<partition:int,offset:bigint>" in plan_of(offsets)
