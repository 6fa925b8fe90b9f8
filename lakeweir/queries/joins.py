"""Joins and averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.operators.averages import average_by, average_joined
from lakeweir.operators.joins import enrich
from lakeweir.queries.base import Query, sql_average, table
from lakeweir.schemas import GROUP_KEYS

MEASURES = {"avg_weight": "weight", "avg_height": "height"}


def gold_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fact = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_returnflag").alias("medal"), F.col("l_linestatus").alias("sex")
    )
    dim = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_type").alias("sport"),
        F.col("p_brand").alias("country_noc"),
        F.col("p_size").alias("weight"),
        F.col("p_retailprice").alias("height"),
    )
    return fact, dim


def gold_averages_of(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    fact, dim = gold_inputs(spark, sf_dir)
    averages = average_joined(
        fact,
        dim,
        on="l_partkey",
        dim_on="p_partkey",
        fact_keys=["medal", "sex"],
        dim_keys=["sport", "country_noc"],
        measures=MEASURES,
        **limits,
    )
    return averages.select(*GROUP_KEYS, *MEASURES)


def gold_avg_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_averages_of(spark, sf_dir)


def gold_avg_stats_wide_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same averages planned as for a dimension too large to broadcast."""
    return gold_averages_of(spark, sf_dir, broadcast_limit=0)


def group_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return average_by(
        lines,
        ["l_returnflag", "l_linestatus"],
        {"avg_quantity": "l_quantity", "avg_price": "l_extendedprice"},
    )


def enriched_events(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"
    )
    return enrich(events, people, "user_id", "c_custkey", **limits).select(
        "fact.event_id",
        "fact.event_type",
        "fact.value",
        "dim.c_custkey",
        "dim.c_mktsegment",
        "dim.c_nationkey",
        "dim.c_acctbal",
    )


def enrich_join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_events(spark, sf_dir)


def enrich_join_inner_wide_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join planned as for a dimension too large to broadcast."""
    return enriched_events(spark, sf_dir, broadcast_limit=0)


def enrich_join_dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides have ``nationkey``; the output takes that of the dimension."""
    fact = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.col("s_nationkey").alias("nationkey")
    )
    dim = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", F.col("c_nationkey").alias("nationkey")
    )
    return enrich(fact, dim, "s_suppkey", "c_custkey").select(
        "fact.s_suppkey", "fact.s_name", "dim.c_mktsegment", "dim.nationkey"
    )


GOLD_SQL = f"""
    SELECT p_type AS sport, l_returnflag AS medal, l_linestatus AS sex, p_brand AS country_noc,
           {sql_average("p_size")} AS avg_weight, {sql_average("p_retailprice")} AS avg_height
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY ALL
"""

ENRICHED_SQL = """
    SELECT event_id, event_type, value, c_custkey, c_mktsegment, c_nationkey, c_acctbal
    FROM events JOIN customer ON user_id = c_custkey
"""

QUERIES = [
    Query("gold_avg_stats", gold_avg_stats, GOLD_SQL),
    Query("gold_avg_stats_wide_dim", gold_avg_stats_wide_dim, GOLD_SQL),
    Query(
        "group_averages",
        group_averages,
        f"""SELECT l_returnflag, l_linestatus, {sql_average("l_quantity")} AS avg_quantity,
                   {sql_average("l_extendedprice")} AS avg_price
            FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    ),
    Query("enrich_join_inner", enrich_join_inner, ENRICHED_SQL),
    Query("enrich_join_inner_wide_dim", enrich_join_inner_wide_dim, ENRICHED_SQL),
    Query(
        "enrich_join_dim_country",
        enrich_join_dim_country,
        """SELECT s_suppkey, s_name, c_mktsegment, c_nationkey AS nationkey
           FROM supplier JOIN customer ON s_suppkey = c_custkey""",
    ),
]
