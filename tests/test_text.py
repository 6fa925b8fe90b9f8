from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.text import (
    clean_text,
    clean_text_columns,
    columns_of_type,
    register_text_cleaner,
)
from tests.helpers import plan_of

CASES = {
    "United States": "UnitedStates",
    None: "None",
    "": "",
    "Zürich": "Zrich",
    "a\\b": "a\\b",
    "it's \"q\"": "it's\"q\"",
    "x-1.5, (y)": "x1.5,y",
    "日本 abc": "abc",
    "😀ok": "ok",
    "[br]^$": "br",
}


def expected(text: str | None) -> str:
    kept = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789,.\\\"'"
    return "".join(c for c in str(text) if c in kept)


def test_edge_rows(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "s string")
    rows = df.select("s", clean_text("s").alias("c")).collect()
    assert {r["s"]: r["c"] for r in rows} == CASES


def test_sql_function_is_the_same_expression(spark):
    register_text_cleaner(spark)
    df = spark.createDataFrame([(k,) for k in CASES], "s string")
    rows = df.selectExpr("s", "clean_text(s) AS c").collect()
    assert {r["s"]: r["c"] for r in rows} == CASES


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text()), min_size=1, max_size=60))
def test_any_text(spark, texts):
    texts = [t if t is None else re.sub("[\ud800-\udfff]", "", t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    rows = df.select("i", clean_text("s").alias("c")).collect()
    assert {r["i"]: r["c"] for r in rows} == {i: expected(t) for i, t in enumerate(texts)}


def test_only_string_columns_change(spark):
    df = spark.createDataFrame([("a b", -1, "c d")], "x string, `n.o` int, `y z` string")
    assert columns_of_type(df, T.StringType) == ["x", "y z"]
    assert clean_text_columns(df).collect() == [("ab", -1, "cd")]
    assert clean_text_columns(df, exclude=["x"]).collect() == [("a b", -1, "cd")]
    assert clean_text_columns(df.select("`n.o`")).collect() == [(-1,)]


def test_no_python_worker(spark):
    plan = clean_text_columns(spark.range(1).select(F.col("id").cast("string"))).select("id")
    assert "Python" not in plan_of(plan)


def test_columns_keep_their_order(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "b")], "i int, s string, d double, t string")
    assert clean_text_columns(df).columns == df.columns


@pytest.mark.parametrize("data_type", [T.IntegerType, T.DoubleType])
def test_columns_of_other_types(spark, data_type):
    df = spark.createDataFrame([(1, 2.0)], "i int, d double")
    assert columns_of_type(df, data_type) == ["i" if data_type is T.IntegerType else "d"]
