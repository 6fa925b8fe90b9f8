from __future__ import annotations

import logging
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.records import from_records, to_records
from lakeweir.operators.duplicates import latest_by_key
from lakeweir.operators.joins import enrich
from lakeweir.plans.topic_jobs import publish_table
from lakeweir.queries.streams import BATCHES, message_files
from lakeweir.schemas import EVENT_RESULTS, GROUP_KEYS
from lakeweir.session import scratch_path
from lakeweir.sinks.files import write_batch
from lakeweir.sources.topics import KafkaTopics, ParquetTopics
from lakeweir.streaming.enriched import build_enriched_stream
from lakeweir.streaming.ledger import BatchLedger
from lakeweir.streaming.run import ROCKSDB, UnfinishedStream, fan_out, run_stream
from tests.athletes import BIO_HEADER, bios, events, stream_answer

logging.getLogger("lakeweir").setLevel(logging.CRITICAL)


def rows_by_key(df):
    return {tuple(r[k] for k in GROUP_KEYS): (r["avg_height"], r["avg_weight"])
            for r in df.collect()}


@pytest.fixture(scope="module")
def bio(spark):
    kinds = "athlete_id int, name string, sex string, height string, weight string, c string"
    df = spark.createDataFrame(bios(), kinds).toDF(*BIO_HEADER)
    return df.withColumns({m: F.nullif(m, F.lit("")) for m in ("height", "weight")})


@pytest.fixture(scope="module")
def results(spark):
    rows = [tuple(None if v == "" else v for v in r) for r in events()]
    return spark.createDataFrame(rows, EVENT_RESULTS)


def publish_split(topics, results, cuts):
    """The rows as ``cuts`` messages files, each a micro-batch of its own."""
    for n in range(cuts):
        part = results.filter(F.pmod(F.xxhash64("result_id", "athlete"), F.lit(cuts)) == n)
        publish_table(part.coalesce(1), topics, "results", sequence=n)


def table_sink(path):
    return fan_out(lambda batch, batch_id: write_batch(batch, path, batch_id))


@pytest.mark.parametrize("limit,copied", [(0, True), (64 << 20, False)])
def test_three_batches_equal_one(spark, bio, results, limit, copied):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_split(topics, results, 3)
    path = scratch_path(spark, "out")
    records = topics.read_stream(spark, "results", max_per_trigger=1)
    copy = scratch_path(spark, "dim") if copied else None
    run = run_stream(
        build_enriched_stream(records, bio, broadcast_limit=limit, bio_copy=copy),
        table_sink(path), scratch_path(spark, "cp"), trigger=None, state_partitions=2,
    )
    assert run.finished and run.last_batch == 2
    changes = spark.read.parquet(path)
    found = rows_by_key(latest_by_key(changes, GROUP_KEYS))
    assert found == stream_answer(bios(), events())
    assert None in {k[1] for k in found}
    stamps = changes.groupBy("batch_id").agg(F.countDistinct("timestamp").alias("n")).collect()
    assert {r["n"] for r in stamps} == {1} and len(stamps) == 3
    batch = build_enriched_stream(topics.read(spark, "results"), bio, broadcast_limit=limit)
    assert rows_by_key(batch) == found
    assert batch.columns == [*GROUP_KEYS, "avg_height", "avg_weight", "timestamp"]


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(cuts=st.integers(1, 4), per_batch=st.integers(1, 3))
def test_any_split_gives_the_same(spark, bio, results, cuts, per_batch):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_split(topics, results, cuts)
    path = scratch_path(spark, "out")
    records = topics.read_stream(spark, "results", max_per_trigger=per_batch)
    run_stream(build_enriched_stream(records, bio), table_sink(path),
               scratch_path(spark, "cp"), trigger=None, state_partitions=2)
    found = latest_by_key(spark.read.parquet(path), GROUP_KEYS)
    assert rows_by_key(found) == stream_answer(bios(), events())


def test_update_mode_sends_changed_groups_only(spark, bio, results):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_table(results.filter("sport = 'Rowing'"), topics, "results", sequence=0)
    path, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "cp")
    records = topics.read_stream(spark, "results")
    for _ in range(2):
        run_stream(build_enriched_stream(records, bio), table_sink(path), checkpoint,
                   trigger=None, state_partitions=2, state_store=ROCKSDB)
        publish_table(results.filter("sport = 'Ski Jump'"), topics, "results", sequence=1)
    sports = spark.read.parquet(path).select("batch_id", "sport").distinct().collect()
    assert sorted(sports) == [(0, "Rowing"), (1, "Ski Jump")]


def test_a_failed_sink_is_tried_again(spark, bio, results):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_split(topics, results, 2)
    first, second = scratch_path(spark, "a"), scratch_path(spark, "b")
    failures = [1]

    def flaky(batch, batch_id):
        if batch_id == 1 and failures:
            failures.pop()
            raise OSError("sink is away")
        write_batch(batch, second, batch_id)

    records = topics.read_stream(spark, "results", max_per_trigger=1)
    run = run_stream(
        build_enriched_stream(records, bio),
        fan_out(lambda b, i: write_batch(b, first, i), flaky),
        scratch_path(spark, "cp"), trigger=None, state_partitions=2, restarts=1,
    )
    assert run.restarts == 1
    for path in (first, second):
        found = latest_by_key(spark.read.parquet(path), GROUP_KEYS)
        assert rows_by_key(found) == stream_answer(bios(), events())
    a, b = (spark.read.parquet(p).drop("timestamp") for p in (first, second))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_sink_that_keeps_failing_is_reported(spark, bio, results):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_table(results, topics, "results")

    def broken(batch, batch_id):
        raise OSError("sink is away")

    with pytest.raises(StreamingQueryException, match="sink is away"):
        run_stream(build_enriched_stream(topics.read_stream(spark, "results"), bio),
                   fan_out(broken), scratch_path(spark, "cp"), trigger=None, state_partitions=2)


def test_empty_batches_reach_no_sink(spark):
    calls = []
    write = fan_out(lambda batch, batch_id: calls.append(batch_id))
    write(spark.range(0), 1)
    write(spark.range(3), 2)
    assert calls == [2]


def test_unparseable_and_unknown_messages_drop_out(spark, bio):
    topics = ParquetTopics(scratch_path(spark, "t"))
    values = [('{"athlete_id":1,"sport":"S"}',), ("{bad",), ('{"athlete_id":999}',), (None,)]
    topics.write(spark.createDataFrame(values, "value string"), "results")
    parsed = from_records(topics.read(spark, "results"), EVENT_RESULTS)
    assert parsed.count() == 4
    assert enrich(parsed, bio.dropDuplicates(["athlete_id"]), "athlete_id").count() == 1


def test_a_run_is_bounded_in_time(spark, bio, results):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_table(results, topics, "results")
    path = scratch_path(spark, "out")
    run = run_stream(
        build_enriched_stream(topics.read_stream(spark, "results"), bio),
        table_sink(path), scratch_path(spark, "cp"),
        trigger="1 second", timeout=8, state_partitions=2,
    )
    assert not run.finished and not spark.streams.active
    found = latest_by_key(spark.read.parquet(path), GROUP_KEYS)
    assert rows_by_key(found) == stream_answer(bios(), events())


def test_session_settings_are_restored(spark, bio, results):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_table(results.limit(5), topics, "results")
    run_stream(build_enriched_stream(topics.read_stream(spark, "results"), bio),
               fan_out(), scratch_path(spark, "cp"), trigger=None, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    name = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" not in spark.conf.get(name, "")


def test_append_mode_is_refused_without_watermark(spark, bio):
    topics = ParquetTopics(scratch_path(spark, "t"))
    topics.write(spark.createDataFrame([("{}",)], "value string"), "results")
    with pytest.raises(AnalysisException, match="(?i)append"):
        run_stream(build_enriched_stream(topics.read_stream(spark, "results"), bio), fan_out(),
                   scratch_path(spark, "cp"), trigger=None, output_mode="append")


def test_output_messages_carry_the_batch(spark):
    topics = ParquetTopics(scratch_path(spark, "t"))
    write = fan_out(lambda batch, i: topics.write(to_records(batch), "out", i))
    write(spark.range(2), 4)
    write(spark.range(2), 4)
    values = [bytes(r["value"]).decode() for r in topics.read(spark, "out").collect()]
    assert sorted(values) == ['{"id":0,"batch_id":4}', '{"id":1,"batch_id":4}']


def test_a_run_that_must_be_complete_raises_when_it_is_cut(spark, tmp_path):
    topics = ParquetTopics(str(tmp_path / "topics"))
    publish_table(spark.range(300), topics, "t", partitions=3)
    stream = topics.read_stream(spark, "t", max_per_trigger=1)

    def slow(batch, batch_id):
        time.sleep(1.5)

    with pytest.raises(UnfinishedStream):
        run_stream(stream, slow, str(tmp_path / "cut"), trigger=None, timeout=1, output_mode="append")
    run = run_stream(stream, slow, str(tmp_path / "whole"), trigger=None, output_mode="append")
    assert run.finished and run.last_batch == 2


def test_intake_is_bounded_by_bytes(spark):
    topics = ParquetTopics(scratch_path(spark, "t"))
    for sequence, rows in enumerate((50, 60, 70, 20_000, 10)):
        publish_table(spark.range(rows).coalesce(1), topics, "n", sequence=sequence)
        time.sleep(1.1)  # files are taken by their time
    seen = []
    records = topics.read_stream(spark, "n", max_bytes=20_000)
    run_stream(records, lambda b, i: seen.append(b.count()), scratch_path(spark, "cp"),
               trigger=None, output_mode="append")
    assert seen == [180, 20_000, 10]
    with pytest.raises(ValueError, match="either"):
        topics.read_stream(spark, "n", max_per_trigger=1, max_bytes=1)


def test_bytes_become_messages_of_a_broker():
    topics = KafkaTopics(None, message_bytes=100)
    assert topics.intake(None, 1000) == 10 and topics.intake(3, 1000) == 3
    assert topics.intake(50, 1000) == 10 and topics.intake(None, 1) == 1
    assert topics.intake(7, None) == 7 and topics.intake(None, None) is None


def test_a_ledger_keeps_batches_from_coming_twice(spark):
    topics = ParquetTopics(scratch_path(spark, "t"))
    for sequence in range(3):
        publish_table(spark.range(10).coalesce(1), topics, "n", sequence=sequence)
    ledger = BatchLedger(scratch_path(spark, "ledger"))
    calls = {"first": [], "second": []}

    def sink(name, lost):
        def write(batch, batch_id):
            calls[name].append(batch_id)
            topics.write(to_records(batch), name, len(calls[name]))
            if calls[name] == lost:
                raise OSError("lost after writing")
        return ledger.once(name, write)

    assert ledger.entries(spark, "first").count() == 0
    records = topics.read_stream(spark, "n", max_per_trigger=1)
    values = records.select(F.col("offset").alias("id"))
    run = run_stream(values, fan_out(sink("first", None), sink("second", [0, 1])),
                     scratch_path(spark, "cp"), trigger=None, output_mode="append", restarts=1)
    assert run.restarts == 1
    assert calls == {"first": [0, 1, 2], "second": [0, 1, 1, 2]}
    schema = "id bigint, batch_id bigint, attempt string"
    for name in calls:
        sent = from_records(topics.read(spark, name), T._parse_datatype_string(schema))
        for limit in (0, 64 << 20):
            once = ledger.taken_once(sent, name, limit)
            assert once.count() == once.select("id").distinct().count() == 30
        assert sorted(r["rows"] for r in ledger.entries(spark, name).collect()) == [10, 10, 10]
    assert topics.read(spark, "second").count() == 40


def test_message_files_grow_with_the_rows(spark, tmp_path):
    """A large table in one file gave three files of messages, so three tasks did all the work."""
    one = str(tmp_path / "events.parquet")
    spark.range(1_000_001).coalesce(1).write.parquet(one)
    assert message_files(spark.read.parquet(one)) == 11
    assert message_files(spark.read.parquet(one).limit(5)) == BATCHES
