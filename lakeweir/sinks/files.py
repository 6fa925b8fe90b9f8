"""Parquet tables and line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeweir.operators.metrics import counted, log, rows_seen


def write_parquet(df: DataFrame, path: str, name: str | None = None) -> int:
    """Replace the table at ``path``; returns the row count, counted by the same job."""
    watched, observation = counted(df, name or "write")
    watched.write.mode("overwrite").parquet(path)
    rows = rows_seen(observation)
    log.info("%s: %d rows written to %s", name or "table", rows, path)
    return rows


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of intermediate data."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def is_stored(df: DataFrame, path: str) -> bool:
    """Whether a whole table lies at ``path``."""
    return exists(df.sparkSession, f"{path}/_SUCCESS")


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """``df`` stored at ``path`` and read from there: its source is asked only once.

    A table that is there already is used as it is.
    """
    if not is_stored(df, path):
        write_parquet(df, path, "snapshot")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store one micro-batch under its number, replacing an earlier attempt of it."""
    kept = df.drop("batch_id")
    kept.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
