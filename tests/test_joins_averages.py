from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeweir.operators.averages import average_by, average_joined
from lakeweir.operators.buckets import bucketed_copy
from lakeweir.operators.joins import (
    SALT,
    counted_hot_keys,
    enrich,
    fits_broadcast,
    measured_bytes,
    profile,
    spread_hot_keys,
    stream_sides,
)
from tests.athletes import averages
from tests.helpers import plan_of

NAN = float("nan")


@pytest.fixture(scope="module")
def sides(spark):
    """Both sides have a key with a third of the rows, NULL keys and keys of their own."""
    rng = random.Random(5)
    fact = [
        (rng.choice([1, None, *range(2, 30)]) if i % 3 else 7, rng.choice("ab"), i)
        for i in range(900)
    ]
    dim = [
        (
            rng.choice([1, None, *range(5, 40)]) if i % 3 else 7,
            rng.choice(["x", "y", None]),
            rng.choice([None, rng.randint(0, 20000) / 100]),
            rng.randint(0, 50),
        )
        for i in range(120)
    ]
    facts = spark.createDataFrame(fact, "k int, f string, row long").repartition(5)
    dims = spark.createDataFrame(dim, "id int, d string, h double, w int").repartition(3)
    pairs = [
        ((f, d), h, float(w)) for k, f, _ in fact for i, d, h, w in dim if k is not None and k == i
    ]
    return facts, dims, pairs


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_average_joined_equals_all_pairs(sides, limit):
    facts, dims, pairs = sides
    found = average_joined(
        facts, dims, "k", "id", ["f"], ["d"], {"mh": "h", "mw": "w"}, broadcast_limit=limit
    )
    assert {(r["f"], r["d"]): (r["mh"], r["mw"]) for r in found.collect()} == averages(pairs)


def test_average_joined_equals_average_over_the_join(sides):
    facts, dims, pairs = sides
    joined = enrich(facts, dims, "k", "id").select("fact.f", "dim.d", "dim.h", "dim.w")
    found = average_by(joined, ["f", "d"], {"mh": "h", "mw": "w"})
    assert {(r["f"], r["d"]): (r["mh"], r["mw"]) for r in found.collect()} == averages(pairs)


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_two_hot_keys_do_not_multiply(spark, limit):
    """Key 7 has 100,000 rows on both sides: ten billion pairs, never spelled out."""
    rows = 300_000
    facts = spark.range(rows).selectExpr("if(id % 3 = 0, 7L, id) AS k", "id % 2 AS f")
    dims = spark.range(rows).selectExpr("if(id % 3 = 0, 7L, id) AS id", "(id % 1000) / 100 AS h")
    found = average_joined(
        facts, dims, "k", "id", ["f"], [], {"m": "h"}, broadcast_limit=limit
    )
    hot = [i for i in range(rows) if i % 3 == 0 or i == 7]
    hot_sum = sum(i % 1000 for i in hot)
    cents, pairs = [0, 0], [0, 0]
    for i in range(rows):
        is_hot = i % 3 == 0 or i == 7
        cents[i % 2] += hot_sum if is_hot else i % 1000
        pairs[i % 2] += len(hot) if is_hot else 1
    expected = {f: round(cents[f] / pairs[f] / 100, 2) for f in (0, 1)}
    assert {r["f"]: r["m"] for r in found.collect()} == expected


def test_nan_reaches_the_average(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "k int, f string")
    dims = spark.createDataFrame([(1, NAN), (2, 1.0), (3, None)], "id int, h double")
    for limit in (0, 1 << 20):
        found = average_joined(facts, dims, "k", "id", ["f"], [], {"m": "h"}, broadcast_limit=limit)
        rows = {r["f"]: r["m"] for r in found.collect()}
        assert str(rows["a"]) == "nan" and rows["b"] is None


def test_hot_key_is_collapsed_before_the_shuffle(sides):
    facts, dims, _ = sides
    plan = plan_of(
        average_joined(facts, dims, "k", "id", ["f"], ["d"], {"m": "h"}, broadcast_limit=0)
    )
    assert "partial_count(1)" in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_enrich_gives_every_pair_once(sides, limit):
    facts, dims, pairs = sides
    joined = enrich(facts, dims, "k", "id", broadcast_limit=limit)
    assert SALT not in joined.columns
    assert joined.count() == len(pairs)
    used = enrich(facts, dims.withColumnRenamed("id", "k"), "k", broadcast_limit=limit)
    assert used.columns == ["k", "f", "row", "d", "h", "w"]
    assert used.count() == len(pairs)
    assert used.groupBy("row").count().count() == joined.select("row").distinct().count()


def skewed(spark):
    """Key 7 is hot in the fact, key -1 in the dimension, and 5,000 keys are cold."""
    fact = spark.range(15000).selectExpr(
        "if(id % 3 = 0, 7L, if(id = 1, -1L, id % 5000)) AS k", "id AS row", "'f' AS c")
    dim = spark.range(9000).selectExpr(
        "if(id >= 6000, -1L, id) AS k", "id AS dim_row", "'d' AS c")
    return fact, dim


def test_hot_keys(spark):
    """One pass tells the size and the keys above an even share; no such key is missed."""
    fact, dim = skewed(spark)
    assert profile(fact, "k", 6).hot == [(7, 3)]
    assert profile(dim, "k", 4).hot == [(-1, 2)]
    assert profile(dim, "k", 4).bytes == measured_bytes(dim)
    assert profile(fact.filter("k is null"), "k", 4).hot == []
    rng = random.Random(3)
    rows = [(f"k{int(rng.paretovariate(0.6))}",) for _ in range(20_000)] + [(None,)] * 9000
    many = spark.createDataFrame(rows, "k string").repartition(7)
    for tasks in (4, 50, 300):
        exact = {k for k, _ in counted_hot_keys(many, "k", -(-20_000 // tasks))}
        found = {k for k, _ in profile(many, "k", tasks).hot}
        assert exact <= found and len(found) < 2 * tasks and None not in found
    odd = many.withColumn("k", F.col("k").cast("binary"))
    assert {bytes(k).decode() for k, _ in profile(odd, "k", 50).hot} == {
        k for k, _ in counted_hot_keys(many, "k", 400)
    }


def jobs_of(spark, group, run):
    context = spark.sparkContext
    context.setJobGroup(group, group)
    try:
        run()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_each_side_is_asked_once_before_the_join(spark, tmp_path):
    fact, dim = skewed(spark)
    for name, df in (("fact", fact), ("dim", dim)):
        df.write.parquet(str(tmp_path / name))
    fact, dim = (spark.read.parquet(str(tmp_path / name)) for name in ("fact", "dim"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # one job per query
    try:
        assert jobs_of(spark, "sides", lambda: enrich(fact, dim, "k", "k", broadcast_limit=1)) == 2
        assert jobs_of(spark, "small", lambda: enrich(fact, dim, "k", "k")) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_equal_rows_of_a_hot_key_are_dealt_out(spark, tmp_path):
    """100,000 rows of one key, with two distinct rows only."""
    path = str(tmp_path / "t")
    spark.range(0, 150_000, 1, 3).selectExpr(
        "if(id % 3 < 2, 7L, id) AS k", "if(id % 3 = 0, 'a', 'b') AS v"
    ).write.parquet(path)
    fact, dim = spark.read.parquet(path), spark.range(50).withColumnRenamed("id", "k")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = spread_hot_keys(fact, dim, "k", "k")
    dealt = [r["count"] for r in left.filter("k = 7").groupBy(SALT).count().collect()]
    assert sum(dealt) == 100_000 and max(dealt) <= 150_000 // width + 3
    assert right.filter("k = 7").count() == len(dealt)
    assert enrich(fact, dim, "k", broadcast_limit=0).count() == fact.join(dim, "k").count()


def test_buckets_are_used_again(spark, tmp_path):
    path = str(tmp_path / "copy")
    rows = spark.range(100).selectExpr("id % 10 AS k", "id AS v")
    first = bucketed_copy(rows, ["k"], path, 3)
    again = bucketed_copy(rows.filter("v < 5"), ["k"], path, 8)
    assert first.count() == again.count() == 100
    for stored in (first, again):
        plan = plan_of(stored.groupBy("k").count(), "simple")
        assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "copy_" not in {t.name[:5] for t in spark.catalog.listTables()}


def test_sides_of_a_stream(spark, tmp_path):
    """The copy keeps its hot keys and buckets; a join with it shuffles the other side only."""
    fact, dim = skewed(spark)
    copy = str(tmp_path / "copy")
    for _ in range(2):
        left, right = stream_sides(fact, dim, "k", "k", F.col("row"), copy, fact)
        joined = left.join(right.hint("merge"), ["k", SALT])
        assert joined.count() == fact.join(dim, "k").count()
        plan = plan_of(joined, "simple")
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
        assert "Bucketed: true" in plan
        dealt = left.filter("k = 7").groupBy(SALT).count().collect()
        assert len(dealt) == 2 and max(r["count"] for r in dealt) <= 2750
        fact = fact.filter("k = 7 or row < 10")


def test_hot_keys_are_dealt_over_tasks(spark):
    fact, dim = skewed(spark)
    joined = enrich(fact, dim, "k", "k", broadcast_limit=0)
    plan = plan_of(joined, "simple")
    assert plan.count("SortMergeJoin") == 1
    assert not re.findall(r"BroadcastHashJoin.*Inner", plan)
    expected = fact.alias("a").join(dim.alias("b"), F.col("a.k") == F.col("b.k"))
    columns = ["row", "dim_row"]
    found, wanted = joined.select(*columns), expected.select(*columns)
    assert found.count() == wanted.count() > 15000
    assert found.exceptAll(wanted).count() == 0
    assert joined.select("fact.c", "dim.c").distinct().collect() == [("f", "d")]
    used = enrich(fact, dim, "k", broadcast_limit=0)
    assert used.columns == ["k", "row", "c", "dim_row", "c"]
    assert used.select("k", "fact.c", "dim.c").count() == wanted.count()


def test_key_hot_on_both_sides(spark, tmp_path):
    """No task of the join gets the whole of it, also with arrays and with keys of two types."""
    for name, rows in (("fact", 3000), ("dim", 900)):
        spark.range(rows).selectExpr(
            "if(id % 3 < 2, 7L, id) AS k", f"id AS {name}_row", "array(id) AS items"
        ).write.parquet(str(tmp_path / name))
    fact, dim = (spark.read.parquet(str(tmp_path / name)) for name in ("fact", "dim"))
    wanted = fact.join(dim, "k").count()
    sides = spread_hot_keys(fact, dim, "k", "k")
    dealt = sides[0].filter("k = 7").groupBy(SALT).count().collect()
    assert len(dealt) > 1 and max(r["count"] for r in dealt) < 1500
    joined = enrich(fact, dim, "k", "k", broadcast_limit=0)
    assert joined.count() == wanted
    assert joined.select("fact_row", "dim_row").distinct().count() == wanted
    assert plan_of(joined, "simple").count("FileScan parquet") == 2
    text = fact.withColumn("k", F.col("k").cast("string"))
    for left, right in ((text, dim), (fact, dim.withColumn("k", F.col("k").cast("int")))):
        assert enrich(left, right, "k", "k", broadcast_limit=0).count() == wanted


def test_shared_names_stay_selectable(spark):
    a = spark.createDataFrame([(1, "left")], "id int, c string")
    b = spark.createDataFrame([(1, "right")], "id int, c string")
    assert enrich(a, b, "id", "id").select("fact.c", "dim.c").first() == ("left", "right")
    assert enrich(a, b, "id").select("id", "dim.c").first() == (1, "right")


def test_size_is_measured_not_guessed(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2)], "s string, n int")
    assert measured_bytes(df) == 2 * 32 + 2
    assert measured_bytes(df.limit(0)) == 0
    assert measured_bytes(df.select(F.array("n"))) is None
    assert fits_broadcast(df, 66) and not fits_broadcast(df, 65) and not fits_broadcast(df, 0)
    assert not fits_broadcast(df.select(F.array("n")), 1 << 30)


def test_only_a_small_dim_is_broadcast(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    dim = spark.range(10)
    assert "SortMergeJoin" in plan_of(enrich(fact, dim, "k", "id", broadcast_limit=1))
    assert "BroadcastHashJoin" in plan_of(enrich(fact, dim, "k", "id"))


def test_null_is_one_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "k string, v double")
    found = average_by(df, ["k"], {"m": "v"})
    assert {r["k"]: r["m"] for r in found.collect()} == {None: 1.5, "a": 3.0}
