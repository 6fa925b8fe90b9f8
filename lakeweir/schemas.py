"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

# The event-result record as it travels in a message.
EVENT_RESULTS = T.StructType(
    [
        T.StructField("edition", T.StringType()),
        T.StructField("edition_id", T.IntegerType()),
        T.StructField("country_noc", T.StringType()),
        T.StructField("sport", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("result_id", T.IntegerType()),
        T.StructField("athlete", T.StringType()),
        T.StructField("athlete_id", T.IntegerType()),
        T.StructField("pos", T.StringType()),
        T.StructField("medal", T.StringType()),
        T.StructField("isTeamSport", T.BooleanType()),
    ]
)

# Spark's own layout of a Kafka message.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Group keys and column types of the averages table.
GROUP_KEYS = ("sport", "medal", "sex", "country_noc")
AVERAGES_DDL = (
    "sport VARCHAR(100), medal VARCHAR(50), sex VARCHAR(10), country_noc VARCHAR(10), "
    "avg_height DOUBLE, avg_weight DOUBLE, timestamp TIMESTAMP"
)
