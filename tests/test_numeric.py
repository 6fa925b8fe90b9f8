from __future__ import annotations

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from lakeweir.functions.numeric import (
    round_half_up,
    rounded_average,
    to_number,
    valid_measures,
)
from lakeweir.functions.text import clean_text
from tests.helpers import plan_of

NAN = float("nan")


def test_clean_then_cast(spark):
    cases = {"180.5": 180.5, "63-67": 6367.0, None: None, "1,80": None, "-5": 5.0}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    rows = df.select("s", to_number(clean_text("s")).alias("n")).collect()
    assert {r["s"]: r["n"] for r in rows} == cases


def test_nan_text_stays_nan_unless_asked(spark):
    df = spark.createDataFrame([("NaN",)], "s string")
    row = df.select(to_number("s").alias("a"), to_number("s", nan_as_null=True).alias("b")).first()
    assert math.isnan(row["a"]) and row["b"] is None


def test_numbers_cast_too(spark):
    df = spark.createDataFrame([(7, 2.5)], "i int, d double")
    assert df.select(to_number("i"), to_number("d")).first() == (7.0, 2.5)
    assert df.select(to_number("i")).schema[0].dataType.simpleString() == "float"


@pytest.mark.parametrize(
    "value,rounded", [(1.005, 1.01), (2.675, 2.68), (0.125, 0.13), (-0.125, -0.13)]
)
def test_half_up(spark, value, rounded):
    assert spark.range(1).select(round_half_up(F.lit(value))).first()[0] == rounded


def test_average_skips_null_and_keeps_nan(spark):
    rows = [("a", 1.0), ("a", None), ("a", 2.0), ("b", 1.0), ("b", NAN), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double").groupBy("k")
    found = {r["k"]: r["m"] for r in df.agg(rounded_average("v").alias("m")).collect()}
    assert found["a"] == 1.5 and math.isnan(found["b"]) and found["c"] is None


def test_scaled_average_does_not_depend_on_partitions(spark):
    cents = [8043, 8044] * 5
    rows = [("a", c / 100) for c in cents] + [("b", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for n in (1, 2, 3, 7):
        spread = df.repartition(n).groupBy("k").agg(rounded_average("v").alias("m"))
        assert {r["k"]: r["m"] for r in spread.collect()} == {"a": 80.44, "b": None}


@pytest.mark.parametrize("kind", ["double", "float", "string"])
def test_valid_measures(spark, kind):
    rows = [(1, 1.0, 2.0), (2, None, 2.0), (3, 1.0, None), (4, NAN, 2.0), (5, 1.0, NAN)]
    df = spark.createDataFrame(rows, "id int, h double, w double")
    df = df.withColumns({c: F.col(c).cast(kind) for c in ("h", "w")})
    assert [r["id"] for r in valid_measures(df, ["h", "w"]).collect()] == [1]


def test_words_pass_unless_strict(spark):
    df = spark.createDataFrame([(1, "63-67"), (2, "None"), (3, "70")], "id int, h string")
    assert [r["id"] for r in valid_measures(df, ["h"]).orderBy("id").collect()] == [1, 2, 3]
    assert [r["id"] for r in valid_measures(df, ["h"], strict=True).collect()] == [3]


def test_valid_measures_of_whole_and_decimal_numbers(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "id int, h int")
    df = df.withColumn("d", F.col("h").cast("decimal(9,2)"))
    assert [r["id"] for r in valid_measures(df, ["h", "d"]).collect()] == [2]
    assert valid_measures(df, []).count() == 2


def test_null_tests_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1.0, "2")], "h double, w string").write.parquet(path)
    plan = plan_of(valid_measures(spark.read.parquet(path), ["h", "w"]))
    assert "IsNotNull(h)" in plan and "IsNotNull(w)" in plan


def test_averages_keep_decimals_and_ignore_order(spark):
    values = [0.004, 0.004, 0.004, 0.01, 1.125, 1.126, -7.333, 1e15, -1e15, 0.1, 0.2]
    for rows, expected in ((values[:4], 0.01), (values[4:6], 1.13), (values[6:7], -7.33)):
        df = spark.createDataFrame([(v,) for v in rows], "v double")
        assert df.agg(rounded_average("v").alias("m")).collect()[0]["m"] == expected
    found = set()
    for order in (values, values[::-1], sorted(values)):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(len(found) + 2)
        found.add(df.agg(rounded_average("v", 6).alias("m")).collect()[0]["m"])
    assert len(found) == 1


def average(spark, values, places):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    return df.agg(rounded_average("v", places).alias("m")).collect()[0]["m"]


def test_decimals_beyond_the_ninth(spark):
    assert average(spark, [4e-10, 4e-10], 10) == 4e-10
    assert average(spark, [1.0000000004, 1.0000000008], 10) == 1.0000000006
    assert average(spark, [-4e-10, -6e-10, None], 10) == -5e-10
    assert average(spark, [1e-300, 1.5], 2) == 0.75
    # 0.1 and 0.2 are their decimals, so the half is rounded up.
    assert average(spark, [0.1, 0.11], 2) == 0.11
    exact = float(sum(Fraction(v) for v in (1 / 3, 2 / 7, 1e-12)) / 3)
    assert average(spark, [1 / 3, 2 / 7, 1e-12], 8) == round(exact, 8)


def test_measures_too_large_for_integers(spark):
    assert average(spark, [1e300], 2) == 1e300
    assert average(spark, [1e19, 2e19], 2) == 1.5e19
    assert average(spark, [1e19, 1.0, None], 2) == 5e18
    assert average(spark, [float("inf"), 1.0], 2) == float("inf")
    assert math.isnan(average(spark, [NAN, 1e19, 1.0], 2))
    assert average(spark, [None], 2) is None
