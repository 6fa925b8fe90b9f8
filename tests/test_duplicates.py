from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lakeweir.operators.duplicates import (
    drop_duplicate_rows,
    drop_wide_duplicate_rows,
    latest_by_key,
)
from lakeweir.operators.metrics import counted, rows_seen
from tests.helpers import plan_of

NAN = float("nan")


def test_equal_rows(spark):
    rows = [(NAN, 0.0), (NAN, -0.0), (None, 1.0), (None, 1.0)]
    assert drop_duplicate_rows(spark.createDataFrame(rows, "a double, b double")).count() == 2


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), max_size=40))
def test_set_of_rows_and_idempotent(spark, rows):
    once = drop_duplicate_rows(spark.createDataFrame(rows, "n int, s string").repartition(3))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(set(rows), key=str)
    assert drop_duplicate_rows(once).count() == len(set(rows))


def test_latest(spark):
    rows = [("a", 1, 1.0), ("a", 3, None), ("a", 2, 9.0), (None, 1, 4.0), ("b", 5, 2.0)]
    changes = spark.createDataFrame(rows, "k string, batch_id long, v double").repartition(3)
    found = latest_by_key(changes, ["k"]).collect()
    assert {r["k"]: (r["batch_id"], r["v"]) for r in found} == {
        "a": (3, None), None: (1, 4.0), "b": (5, 2.0)}


def test_replays_leave_one_row(spark):
    rows = [("a", 1, 1.0), ("a", 1, 1.0), ("a", 1, 2.0)]
    changes = spark.createDataFrame(rows, "k string, batch_id long, v double")
    assert latest_by_key(changes, ["k"]).count() == 1


def test_rows_counted_by_the_running_job(spark):
    df, seen = counted(spark.range(10), "ten")
    assert df.filter("id > 3").collect()[0]["id"] == 4
    assert rows_seen(seen) == 10


def test_latest_by_key_takes_the_later_stamp_of_a_replay(spark):
    rows = [("a", 5, 180.0, 1), ("a", 5, 170.0, 2), ("a", 4, 190.0, 3)]
    changes = spark.createDataFrame(rows, "k string, batch_id bigint, m double, timestamp bigint")
    assert latest_by_key(changes, ["k"]).collect()[0]["m"] == 170.0


WIDE = "a double, b double, s string, l array<double>"
WIDE_ROWS = [
    (NAN, 0.0, "x", [0.0]), (NAN, -0.0, "x", [-0.0]), (None, 1.0, None, None), (1.0, None, None, None),
    (None, 1.0, None, None), (2.0, 2.0, "", []), (2.0, 2.0, None, []), (3.0, 3.0, "alone", [NAN]),
]


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_wide_rows(spark, limit):
    df = spark.createDataFrame(WIDE_ROWS, WIDE).repartition(3)
    found = drop_wide_duplicate_rows(df, limit)
    assert found.columns == df.columns and found.count() == 6
    assert drop_wide_duplicate_rows(df.limit(0), limit).count() == 0


def test_wide_rows_with_one_digest_stay_apart(spark, monkeypatch):
    monkeypatch.setattr("lakeweir.operators.duplicates.F.xxhash64", lambda *_: F.lit(7))
    df = spark.createDataFrame(WIDE_ROWS, WIDE)
    assert drop_wide_duplicate_rows(df).count() == 6


def test_only_repeated_wide_rows_are_shuffled(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("s"))
    rows.union(rows.limit(10)).write.parquet(str(tmp_path / "t"))
    found = drop_wide_duplicate_rows(spark.read.parquet(str(tmp_path / "t")))
    assert found.count() == 1000
    plan = plan_of(found)
    assert plan.count("Arguments: hashpartitioning") == 1 and "LeftAnti" in plan


def test_texts_equal_by_collation(spark):
    df = spark.sql("SELECT c COLLATE UTF8_LCASE AS c FROM VALUES ('a'), ('A') t(c)")
    assert drop_wide_duplicate_rows(df).count() == 1
