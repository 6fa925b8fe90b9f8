"""Tables stored in sorted buckets, so that joins on their keys need not shuffle them again."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeweir.sinks.files import is_stored


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Number of buckets of the copy at ``path``, or None if there is none."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/buckets-*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [status.getPath().getParent().getName() for status in found or []]
    return int(names[0].removeprefix("buckets-")) if names else None


def bucketed_copy(df: DataFrame, keys: Sequence[str], path: str, buckets: int) -> DataFrame:
    """``df`` stored below ``path`` in ``buckets`` files, dealt by ``keys`` and sorted by them.

    A copy that is there already is used as it is, with the buckets it has. The table name
    is only needed to tell Spark of the buckets, and is dropped at once; the files stay.
    """
    spark = df.sparkSession
    buckets = bucket_count(spark, path) or buckets
    place, name = f"{path}/buckets-{buckets}", f"copy_{uuid.uuid4().hex}"
    if is_stored(df, place):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        listed = ", ".join(f"`{key}`" for key in keys)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) "
            f"SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    else:
        # One task per bucket: one sorted file each.
        dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
        dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(
            *keys
        ).option("path", place).saveAsTable(name)
    stored = spark.table(name)
    stored.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return stored
