"""Processing time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, name: str = "timestamp") -> DataFrame:
    """Add the processing time: one value per query, or per micro-batch of a stream."""
    return df.withColumn(name, F.current_timestamp())
