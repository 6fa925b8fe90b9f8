"""Queries on one table: cleaning, casts, filters, rounding, JSON, duplicates, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.functions.numeric import (
    rounded_average,
    round_half_up,
    to_number,
    valid_measures,
)
from lakeweir.functions.records import from_records, to_records
from lakeweir.functions.stamps import stamp
from lakeweir.functions.text import clean_text, clean_text_columns, register_text_cleaner
from lakeweir.operators.duplicates import drop_duplicate_rows, drop_wide_duplicate_rows
from lakeweir.queries.base import Query, sql_clean, sql_round, table


def text_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with measures kept as text: numbers, NULL, ``NaN`` and words."""
    balance = F.col("c_acctbal").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", None)
        .when(F.col("c_mktsegment") == "MACHINERY", "NaN")
        .otherwise(balance)
        .alias("height"),
        F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(balance).alias("weight"),
    )


TEXT_MEASURES_SQL = """
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                WHEN c_mktsegment = 'MACHINERY' THEN 'NaN'
                ELSE CAST(c_acctbal AS VARCHAR) END AS height,
           CASE WHEN c_acctbal < 0 THEN c_mktsegment
                ELSE CAST(c_acctbal AS VARCHAR) END AS weight
    FROM customer
"""


def filter_valid_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_measures(text_measures(spark, sf_dir), ["height", "weight"])


def filter_valid_measures_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_measures(text_measures(spark, sf_dir), ["height", "weight"], strict=True)


def clean_text_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        clean_text("text").alias("text"),
        clean_text(F.nullif("lang", F.lit("de"))).alias("lang"),
    )


def clean_text_sql_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_text_cleaner(spark)
    documents = table(spark, sf_dir, "documents")
    return documents.selectExpr("doc_id", "clean_text(text) AS text", "clean_text(source) AS source")


def clean_all_text_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_text_columns(table(spark, sf_dir, "part"))


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_duplicate_rows(table(spark, sf_dir, "documents").select("text", "lang"))


def dedup_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows that occur more than once are shuffled."""
    return drop_wide_duplicate_rows(table(spark, sf_dir, "documents").drop("doc_id", "source"))


def numeric_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = text_measures(spark, sf_dir)
    return measures.select(
        "c_custkey",
        to_number("height", nan_as_null=True).alias("height"),
        to_number("weight").alias("weight"),
        to_number(clean_text("weight")).alias("cleaned_weight"),
    )


def round_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.col("value") / 2
    return table(spark, sf_dir, "events").select(
        "event_id", round_half_up(half).alias("up"), round_half_up(-half).alias("down")
    )


def avg_null_nan_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type that is all NULL, one that has a NaN, and the rest."""
    value = (
        F.when(F.col("event_type") == "error", None)
        .when((F.col("event_type") == "signup") & (F.col("value") < 1), F.lit(float("nan")))
        .when(F.col("value") > 400, None)
        .otherwise(F.col("value"))
    )
    events = table(spark, sf_dir, "events").select("event_type", value.alias("value"))
    grouped = events.groupBy("event_type").agg(
        F.count("*").alias("n_rows"),
        F.count("value").alias("n_values"),
        rounded_average("value").alias("mean"),
    )
    return grouped.select(
        "event_type",
        "n_rows",
        "n_values",
        F.isnan("mean").alias("is_nan"),
        F.when(~F.isnan("mean"), F.col("mean")).alias("mean"),
    )


def row_count_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, kept and joined, by aggregates that a repeated stage cannot change.

    The pairs of the join are counted from the rows per key, without spelling them out.
    """
    measures = text_measures(spark, sf_dir)
    kept = valid_measures(measures, ["height", "weight"])
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    people = kept.groupBy("c_custkey").agg(F.count("*").alias("m"))
    matched = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    parts = {
        "rows_read": measures.agg(F.count("*").alias("rows")),
        "rows_valid": kept.agg(F.count("*").alias("rows")),
        "rows_joined": matched.agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0)).alias("rows")),
    }
    named = [part.select(F.lit(name).alias("name"), "rows") for name, part in parts.items()]
    return reduce(DataFrame.union, named).agg(
        *(F.sum(F.when(F.col("name") == name, F.col("rows"))).alias(name) for name in parts)
    )


def stamp_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = stamp(table(spark, sf_dir, "events").select("event_id"))
    return stamped.agg(
        F.count("*").alias("n_rows"),
        F.count("timestamp").alias("n_stamped"),
        (F.min("timestamp") == F.max("timestamp")).alias("one_stamp"),
    )


def json_serialize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kind = F.nullif("event_type", F.lit("error")).alias("event_type")
    return to_records(events.select("event_id", "ts", "user_id", kind, "value", "props"))


def json_parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return from_records(to_records(events), events.schema)


QUERIES = [
    Query(
        "filter_valid_measures",
        filter_valid_measures,
        f"""SELECT * FROM ({TEXT_MEASURES_SQL})
            WHERE height IS NOT NULL AND NOT coalesce(isnan(try_cast(height AS double)), false)
              AND weight IS NOT NULL AND NOT coalesce(isnan(try_cast(weight AS double)), false)""",
    ),
    Query(
        "filter_valid_measures_strict",
        filter_valid_measures_strict,
        f"""SELECT * FROM ({TEXT_MEASURES_SQL})
            WHERE NOT isnan(try_cast(height AS double)) AND NOT isnan(try_cast(weight AS double))""",
    ),
    Query(
        "clean_text_native",
        clean_text_native,
        f"""SELECT doc_id, {sql_clean("text")} AS text,
                   {sql_clean("nullif(lang, 'de')")} AS lang FROM documents""",
    ),
    Query(
        "clean_text_sql_function",
        clean_text_sql_function,
        f"""SELECT doc_id, {sql_clean("text")} AS text,
                   {sql_clean("source")} AS source FROM documents""",
    ),
    Query(
        "clean_all_text_columns",
        clean_all_text_columns,
        f"""SELECT p_partkey, {sql_clean("p_name")} AS p_name, {sql_clean("p_brand")} AS p_brand,
                   {sql_clean("p_type")} AS p_type, p_size, p_retailprice FROM part""",
    ),
    Query("dedup_rows", dedup_rows, "SELECT DISTINCT text, lang FROM documents"),
    Query(
        "dedup_wide_rows",
        dedup_wide_rows,
        "SELECT DISTINCT text, lang, n_chars FROM documents",
    ),
    Query(
        "numeric_try_cast",
        numeric_try_cast,
        f"""SELECT c_custkey,
                   CASE WHEN NOT isnan(try_cast(height AS float)) THEN try_cast(height AS float)
                   END AS height,
                   try_cast(weight AS float) AS weight,
                   try_cast({sql_clean("weight")} AS float) AS cleaned_weight
            FROM ({TEXT_MEASURES_SQL})""",
    ),
    Query(
        "round_half_up",
        round_halves,
        f"""SELECT event_id, {sql_round("value / 2")} AS up,
                   {sql_round("-(value / 2)")} AS down FROM events""",
    ),
    Query(
        "avg_null_nan_rules",
        avg_null_nan_rules,
        f"""WITH v AS (
              SELECT event_type,
                     CASE WHEN event_type = 'error' THEN NULL
                          WHEN event_type = 'signup' AND value < 1 THEN 'NaN'::double
                          WHEN value > 400 THEN NULL ELSE value END AS value
              FROM events),
            g AS (
              SELECT event_type, count(*) AS n_rows, count(value) AS n_values,
                     coalesce(bool_or(isnan(value)), false) AS is_nan,
                     avg(CASE WHEN NOT isnan(value) THEN value END) AS mean
              FROM v GROUP BY event_type)
            SELECT event_type, n_rows, n_values, is_nan,
                   CASE WHEN NOT is_nan THEN {sql_round("mean")} END AS mean FROM g""",
    ),
    Query(
        "row_count_metrics",
        row_count_metrics,
        f"""WITH m AS ({TEXT_MEASURES_SQL}),
            k AS (SELECT * FROM m
                  WHERE height IS NOT NULL AND weight IS NOT NULL
                    AND NOT coalesce(isnan(try_cast(height AS double)), false)
                    AND NOT coalesce(isnan(try_cast(weight AS double)), false))
            SELECT (SELECT count(*) FROM m) AS rows_read, (SELECT count(*) FROM k) AS rows_valid,
                   (SELECT count(*) FROM orders JOIN k ON o_custkey = c_custkey) AS rows_joined""",
    ),
    Query(
        "stamp_processing_time",
        stamp_processing_time,
        "SELECT count(*) AS n_rows, count(*) AS n_stamped, true AS one_stamp FROM events",
    ),
    Query(
        "json_serialize_records",
        json_serialize_records,
        """SELECT '{"event_id":' || event_id
                  || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"'
                  || ',"user_id":' || user_id
                  || CASE WHEN event_type = 'error' THEN ''
                          ELSE ',"event_type":' || to_json(event_type) END
                  || ',"value":' || value
                  || ',"props":' || to_json(props) || '}' AS value
           FROM events""",
    ),
    Query(
        "json_parse_records",
        json_parse_records,
        "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    ),
]
