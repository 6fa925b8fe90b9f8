"""Database tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeweir.config import JdbcConfig

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class Split:
    """Range split of a numeric or date column, one connection per range."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_read_options(
    conn: JdbcConfig, table: str, split: Split | None = None, fetch_rows: int = FETCH_ROWS
) -> dict[str, str]:
    options = {
        "url": conn.url,
        "driver": conn.driver,
        "dbtable": table,
        "user": conn.user,
        "password": conn.password,
        "fetchsize": str(fetch_rows),
    }
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    conn: JdbcConfig,
    table: str,
    split: Split | None = None,
    predicates: Iterable[str] | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> DataFrame:
    """Scan a table, in parallel when ``split`` or ``predicates`` are given.

    ``predicates`` are WHERE conditions, one partition each, for keys whose
    ranges are uneven. They must not overlap and must cover every row.
    """
    options = jdbc_read_options(conn, table, split, fetch_rows)
    if predicates is None:
        return spark.read.format("jdbc").options(**options).load()
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(conn.url, table, predicates=list(predicates), properties=properties)
