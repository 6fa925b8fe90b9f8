from __future__ import annotations

import csv
import logging
import os
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.operators.metrics import joined_rows
from lakeweir.plans.lake import (
    GoldTable,
    Lake,
    bronze_to_silver,
    gold_averages,
    landing_to_bronze,
    layer_rows,
    run_lake,
    run_rows,
    silver_to_gold,
    with_retries,
)
from lakeweir.sources.files import (
    FAMILIES,
    highest,
    most_digits,
    read_csv,
    read_csv_once,
    read_parquet,
    text_class,
    type_of,
)
from tests.athletes import BIO_HEADER, EVENT_HEADER, batch_answer, bios, events

KEYS = ("sport", "medal", "sex", "country_noc")


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture
def landing(tmp_path):
    write_csv(tmp_path / "athlete_bio.csv", BIO_HEADER, bios())
    write_csv(tmp_path / "athlete_event_results.csv", EVENT_HEADER, events())
    return str(tmp_path)


def rows_by_key(df):
    return {tuple(r[k] for k in KEYS): (r["avg_height"], r["avg_weight"]) for r in df.collect()}


def test_csv_types_and_quotes(spark, tmp_path):
    text = 'id,height,name,d\n1,180.0,"B, b",2024-01-02\n2,,x,2024-01-03\n3,63-67,y,2024-01-04\n'
    (tmp_path / "t.csv").write_text(text)
    df = read_csv(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "string", "date"]
    assert df.collect() == [
        (1, "180.0", "B, b", date(2024, 1, 2)),
        (2, None, "x", date(2024, 1, 3)),
        (3, "63-67", "y", date(2024, 1, 4)),
    ]
    schema = T.StructType().add("id", "long").add("height", "double")
    schema = schema.add("name", "string").add("d", "string")
    assert read_csv(spark, str(tmp_path / "t.csv"), schema).schema == schema


def test_whole_lake(spark, landing, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    run_lake(spark, landing, lake)
    gold = read_parquet(spark, lake.path("gold", "avg_stats"))
    assert gold.columns == [*KEYS, "avg_weight", "avg_height", "timestamp"]
    assert gold.select("timestamp").distinct().count() == 1
    assert rows_by_key(gold) == batch_answer(bios(), events())
    assert "None" in {r["medal"] for r in gold.collect()}


def test_steps_count_rows_and_can_run_again(spark, landing, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    for _ in range(2):
        assert landing_to_bronze(spark, landing, lake) == {
            "athlete_bio": 67, "athlete_event_results": 430}
        assert bronze_to_silver(spark, lake) == {
            "athlete_bio": 60, "athlete_event_results": 400}
        assert silver_to_gold(spark, lake) == len(batch_answer(bios(), events()))


def test_declared_schema_skips_inference(spark, landing, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    schema = T.StructType()
    for name in BIO_HEADER:
        schema = schema.add(name, "string")
    landing_to_bronze(spark, landing, lake, ["athlete_bio"], {"athlete_bio": schema})
    assert read_parquet(spark, lake.path("bronze", "athlete_bio")).schema == schema


def test_excluded_columns_keep_their_sign(spark, landing, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    landing_to_bronze(spark, landing, lake, ["athlete_bio"])
    bronze_to_silver(spark, lake, ["athlete_bio"], exclude=["height", "weight"])
    silver = read_parquet(spark, lake.path("silver", "athlete_bio"))
    assert "-5" in {r["weight"] for r in silver.collect()}
    assert {r["name"] for r in silver.collect()} >= {"Mller,0"}


def test_wide_dimension_gives_the_same_gold(spark, landing, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    landing_to_bronze(spark, landing, lake)
    bronze_to_silver(spark, lake)
    fact = read_parquet(spark, lake.path("silver", "athlete_event_results"))
    dim = read_parquet(spark, lake.path("silver", "athlete_bio"))
    wide = gold_averages(fact, dim, GoldTable(), broadcast_limit=0)
    assert rows_by_key(wide) == batch_answer(bios(), events())


def test_nan_option(spark):
    fact = spark.createDataFrame(
        [("s", "m", 1), ("s", "m", 2)], "sport string, medal string, athlete_id int")
    dim = spark.createDataFrame(
        [(1, "F", "X", "NaN", "1"), (2, "F", "X", "3", "2")],
        "athlete_id int, sex string, country_noc string, height string, weight string",
    )
    kept = gold_averages(fact, dim, GoldTable()).first()
    assert str(kept["avg_height"]) == "nan" and kept["avg_weight"] == 1.5
    assert gold_averages(fact, dim, GoldTable(nan_as_null=True)).first()["avg_height"] == 3.0


def test_one_retry(caplog):
    caplog.set_level(logging.CRITICAL, logger="lakeweir")
    calls = []

    def fails_until(n):
        def step():
            calls.append(1)
            if len(calls) < n:
                raise OSError("busy")
            return "done"
        return step

    assert with_retries(fails_until(2), 1, "step") == "done"
    calls.clear()
    with pytest.raises(OSError):
        with_retries(fails_until(3), 1, "step")
    assert len(calls) == 2


def test_a_failing_step_stops_the_lake(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(Exception, match="(?i)path"):
        run_lake(spark, str(tmp_path / "nothing"), lake, retries=0)
    assert not os.path.exists(lake.root)


def test_runs_keep_exact_counts(spark, landing, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    calls = []

    def fails_once(*args):
        calls.append(1)
        if len(calls) == 1:
            raise OSError("lost after the tables were written")
        return layer_rows(*args)

    monkeypatch.setattr("lakeweir.plans.lake.layer_rows", fails_once)
    logging.getLogger("lakeweir").setLevel(logging.CRITICAL)
    assert run_lake(spark, landing, lake, run="a") == "a"
    found = {(r["step"], r["table_name"]): (r["rows_read"], r["rows_joined"], r["rows_written"])
             for r in run_rows(spark, lake).filter("run = 'a'").collect()}
    silver = {t: read_parquet(spark, lake.path("silver", t)) for t in
              ("athlete_bio", "athlete_event_results")}
    joined = silver["athlete_bio"].join(silver["athlete_event_results"], "athlete_id").count()
    assert found == {
        ("bronze", "athlete_bio"): (67, None, 67),
        ("bronze", "athlete_event_results"): (430, None, 430),
        ("silver", "athlete_bio"): (67, None, 60),
        ("silver", "athlete_event_results"): (430, None, 400),
        ("gold", "athlete_bio"): (60, None, None),
        ("gold", "athlete_event_results"): (400, None, None),
        ("gold", "avg_stats"): (None, joined, len(batch_answer(bios(), events()))),
    }
    run_lake(spark, landing, lake, run="b")
    assert run_rows(spark, lake).groupBy("run").count().collect() in (
        [("a", 7), ("b", 7)], [("b", 7), ("a", 7)])


CSV_COLUMNS = {
    "int": ["1", "-2", "+3", ""],
    "bigint": ["1", "3000000000", "", ""],
    "decimal(20,0)": ["1", "12345678901234567890", "", "-5"],
    "decimal(25,0)": ["1234567890123456789012345", "0", "1", ""],
    "double": ["1", "1.50", "1e5", "NaN"],
    "date": ["2024-01-02", "", "2023-12-31", "2020-02-29"],
    "timestamp": ["2024-01-02", "2024-01-02 03:04:05", "", "2024-01-02T03:04:05.123"],
    "boolean": ["true", "FALSE", "", "False"],
    "string": ["1", "63-67", "", "2"],
}


def test_types_in_one_pass_are_those_of_two(spark, tmp_path):
    mixed = {"time_and_number": ["2024", "2024-01-02", "", "1"], "none": ["", "", "", ""],
             "truth_and_number": ["true", "1", "", ""], "time_and_text": ["2024-01-02", "x", "", ""],
             "a.b` c": ["1", "2", "3", "4"]}
    columns = CSV_COLUMNS | mixed
    write_csv(tmp_path / "t.csv", list(columns), list(zip(*columns.values())))
    once = read_csv_once(spark, str(tmp_path / "t.csv"), str(tmp_path / "copy"))
    twice = read_csv(spark, str(tmp_path / "t.csv"))
    kinds = [(f.name, f.dataType.simpleString()) for f in once.schema]
    assert kinds == [(f.name, f.dataType.simpleString()) for f in twice.schema]
    assert kinds[: len(CSV_COLUMNS)] == [(k, k) for k in CSV_COLUMNS]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_one_pass_over_a_csv_without_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n")
    df = read_csv_once(spark, str(tmp_path / "t.csv"), str(tmp_path / "copy"))
    assert df.columns == ["a", "b"] and df.count() == 0


def test_joined_rows_of_repeated_and_missing_keys(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "b int")
    assert joined_rows(left, right, "a", "b") == 6
    assert joined_rows(left, right.filter("b = 3"), "a", "b") == 0


def test_classing_texts_costs_no_more_than_a_few_reads(spark, tmp_path):
    """Casts that fail raise errors inside Spark: on texts they took ten times as long as reading them."""
    rows = spark.range(400_000).select(
        F.concat(F.lit("text "), "id").alias("a"),
        F.concat("id", F.lit("-LOW")).alias("b"),
        (F.col("id") + 3_000_000_000).alias("c"),
        F.lit("1998-02-06T00:00:00.000").alias("d"),
    )
    path = str(tmp_path / "t.csv")
    rows.coalesce(1).write.option("header", True).csv(path)

    def seconds(run):
        taken = []
        for _ in range(3):
            begun = time.perf_counter()
            run(len(taken))
            taken.append(time.perf_counter() - begun)
        return min(taken)

    once = seconds(lambda n: read_csv_once(spark, path, str(tmp_path / f"once-{n}")))
    twice = seconds(lambda n: read_csv(spark, path).write.parquet(str(tmp_path / f"twice-{n}")))
    assert once < 4 * twice


def test_classes_of_odd_whole_numbers(spark):
    kinds = {"2147483648": "bigint", "-2147483648": "int", "0" * 20 + "12": "int", "9" * 19: "decimal(20,0)",
             "9223372036854775807": "bigint", "9" * 38: "decimal(38,0)", "9" * 39: "double", "0" * 50: "int",
             "0x1p3": "double", "0x1.2.3p1": "string", "-Infinity": "double", " 1": "double", "1e": "string", "12\x85": "string"}
    texts = spark.createDataFrame([(text,) for text in kinds], "text string")
    for text, bits in texts.select("text", text_class(F.col("text"))).collect():
        classes = [highest(bits, family) for family in FAMILIES]
        assert type_of(classes[0], most_digits(bits), *classes[1:]) == kinds[text], text
