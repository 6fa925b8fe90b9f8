"""Intermediate tables in the shared folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from lakeweir.llm.memory import release
from lakeweir.session import scratch_path


class Workspace:
    """Tables written on the way to a result.

    A written table cuts the lineage: an executor that is lost later costs the
    tasks that read it, not the jobs before it. ``drop`` removes a table that
    nothing will read again; what the returned frame reads stays.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, name)
        self.count = 0

    def store(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}-{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored.workspace_path = path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in stored:
            path = jvm.org.apache.hadoop.fs.Path(df.workspace_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        # Spark's cleaner removes shuffle files of finished steps when their plans are collected.
        gc.collect()
        release()
        jvm.System.gc()
