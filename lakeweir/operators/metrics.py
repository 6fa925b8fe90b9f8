"""Row counts: of the running job, of stored tables, of joins."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("lakeweir")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count attached; read it after an action has run.

    A diagnostic: a stage that runs again after an executor is lost may be
    counted twice, so nothing is decided from it.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def rows_seen(observation: Observation) -> int:
    return observation.get["rows"]


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of the Parquet table at ``path``, from the footers of its files.

    A file is there once, whatever was repeated while it was written, so no retry changes the count.
    """
    return spark.read.parquet(path).count()


def joined_rows(left: DataFrame, right: DataFrame, on: str, right_on: str) -> int:
    """Rows of the inner join, which is not made: rows per key of both sides, multiplied."""

    def per_key(df: DataFrame, key: str, name: str) -> DataFrame:
        keys = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
        return keys.groupBy("key").agg(F.count("*").cast("decimal(19,0)").alias(name))

    pairs = per_key(left, on, "n").join(per_key(right, right_on, "m"), "key")
    return int(pairs.agg(F.sum(F.col("n") * F.col("m")).alias("rows")).first()["rows"] or 0)


def log_sample(df: DataFrame, name: str, rows: int = 2) -> None:
    """Log a few rows, only when debug logging is on, as this costs a job."""
    if log.isEnabledFor(logging.DEBUG):
        for row in df.take(rows):
            log.debug("%s: %s", name, row)
