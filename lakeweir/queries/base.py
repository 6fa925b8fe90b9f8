"""What a registered query is."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


# The test tables' columns. Declared, so that no query starts with a job that
# opens files to find out.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def sql_round(expression: str, places: int = 2) -> str:
    """Half-up rounding of a double in SQL, on its shortest decimal form as Spark does."""
    return (
        f"cast(round(cast(cast({expression} as varchar) as decimal(38,12)), {places}) as double)"
    )


def sql_average(column: str, scale: int = 2) -> str:
    """Rounded average over whole units, independent of row order."""
    factor = f"{10**scale}.0::double"
    units = f"cast(round(cast({column} as double) * {factor}) as bigint)"
    return sql_round(f"cast(sum({units}) as double) / ({factor} * count({column}))")


def sql_clean(column: str) -> str:
    return f"""regexp_replace(coalesce({column}, 'None'), '[^a-zA-Z0-9,.\\\\"'']', '', 'g')"""
