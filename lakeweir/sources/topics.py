"""Topics: streams of messages in Spark's Kafka layout.

``KafkaTopics`` talks to brokers. ``ParquetTopics`` keeps the same columns in a
folder, for backfills and for runs without a broker. Jobs take either one.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.config import KafkaConfig
from lakeweir.schemas import TOPIC

# How the publisher batches and how long it waits.
PUBLISH_SETTINGS = {
    "kafka.request.timeout.ms": "60000",
    "kafka.max.block.ms": "60000",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "5",
}
Offsets = Mapping[int, int]
MESSAGE_BYTES = 256  # what a message is taken to hold where brokers cannot be asked for bytes
# What a topic's own folder holds: its name is in the path.
STORED = T.StructType([f for f in TOPIC.fields if f.name != "topic"])


def kafka_login_options(conn: KafkaConfig) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": conn.bootstrap_servers,
        "kafka.security.protocol": conn.security_protocol,
        "kafka.sasl.mechanism": conn.sasl_mechanism,
        "kafka.sasl.jaas.config": conn.jaas,
    }


def kafka_publish_options(conn: KafkaConfig, topic: str | None) -> dict[str, str]:
    """Without a topic, every row names its own in a ``topic`` column."""
    options = kafka_login_options(conn) | PUBLISH_SETTINGS
    return options | {"topic": topic} if topic else options


def kafka_subscribe_options(
    conn: KafkaConfig,
    topic: str | None = None,
    pattern: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    options = kafka_login_options(conn)
    options |= {"subscribe": topic} if topic else {"subscribePattern": pattern}
    options |= {
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_range_options(
    conn: KafkaConfig, topic: str, start: Offsets | None, end: Offsets | None
) -> dict[str, str]:
    """Bounds of some partitions assign these alone, as in ``within``."""
    options = kafka_login_options(conn)
    if not start and not end:
        return options | {
            "subscribe": topic,
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
        }
    partitions = sorted(set(start or end) & set(end or start))
    if not partitions:
        raise ValueError("no partition has both a start and an end")

    def bounds(offsets: Offsets | None, default: str) -> str:
        return json.dumps({topic: {str(p): offsets[p] for p in partitions}}) if offsets else default

    return options | {
        "assign": json.dumps({topic: partitions}),
        "startingOffsets": bounds(start, "earliest"),
        "endingOffsets": bounds(end, "latest"),
    }


@dataclass(frozen=True)
class KafkaTopics:
    """Topics on brokers. Writing is at least once: a repeated batch is sent again."""

    conn: KafkaConfig
    fail_on_data_loss: bool = True
    message_bytes: int = MESSAGE_BYTES

    def intake(self, messages: int | None, max_bytes: int | None) -> int | None:
        """The smaller of two bounds of a micro-batch, in messages."""
        if not max_bytes:
            return messages
        within_bytes = max(1, max_bytes // self.message_bytes)
        return min(messages or within_bytes, within_bytes)

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: Offsets | None = None,
        end: Offsets | None = None,
    ) -> DataFrame:
        options = kafka_range_options(self.conn, topic, start, end)
        return spark.read.format("kafka").options(**options).load()

    def read_stream(
        self,
        spark: SparkSession,
        topic: str | None = None,
        pattern: str | None = None,
        max_per_trigger: int | None = None,
        min_partitions: int | None = None,
        max_bytes: int | None = None,
    ) -> DataFrame:
        """``max_per_trigger`` counts messages. ``max_bytes`` is taken at ``message_bytes`` a message."""
        max_per_trigger = self.intake(max_per_trigger, max_bytes)
        options = kafka_subscribe_options(
            self.conn, topic, pattern, max_per_trigger, min_partitions, self.fail_on_data_loss
        )
        return spark.readStream.format("kafka").options(**options).load()

    def write(self, records: DataFrame, topic: str | None = None, sequence: int = 0) -> None:
        options = kafka_publish_options(self.conn, topic)
        records.write.format("kafka").options(**options).save()


def within(start: Offsets | None, end: Offsets | None) -> Column:
    """Start offsets are included, end offsets are not; absent partitions are not read.

    The widest bounds are compared with plain literals, which the scan can use
    to skip row groups; the map then applies each partition's own bound.
    """
    offset = F.col("offset")

    def own(bounds: Offsets) -> Column:
        limits = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])
        return F.try_element_at(limits, F.col("partition")).cast("bigint")

    test = F.lit(True)
    if start:
        test &= (offset >= min(start.values())) & (offset >= own(start))
    if end:
        test &= (offset < max(end.values())) & (offset < own(end))
    return test


@dataclass(frozen=True)
class ParquetTopics:
    """Topics below one folder: ``<root>/topic=<name>/write=<sequence>/``.

    A write with the same sequence number replaces the earlier one, so a
    repeated batch does not store its messages twice. The partition is that of
    the writing task and the offset counts its rows, which needs no shuffle
    and no window; a later sequence has higher offsets.
    """

    root: str

    def _path(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"

    @staticmethod
    def _named(stored: DataFrame, topic: str) -> DataFrame:
        return stored.withColumn("topic", F.lit(topic)).select(*TOPIC.fieldNames())

    def read(
        self,
        spark: SparkSession,
        topic: str,
        start: Offsets | None = None,
        end: Offsets | None = None,
    ) -> DataFrame:
        stored = spark.read.schema(STORED).parquet(self._path(topic))
        return self._named(stored, topic).filter(within(start, end))

    def read_all(self, spark: SparkSession) -> DataFrame:
        """Messages of all topics."""
        return spark.read.schema(TOPIC).parquet(self.root).select(*TOPIC.fieldNames())

    def read_stream(
        self,
        spark: SparkSession,
        topic: str | None = None,
        pattern: str | None = None,
        max_per_trigger: int | None = None,
        min_partitions: int | None = None,
        max_bytes: int | None = None,
    ) -> DataFrame:
        """``max_per_trigger`` counts files here, ``max_bytes`` their stored bytes.

        Only one of them can be given. A file beyond ``max_bytes`` is a batch of its own. A pattern must
        match the whole topic name.
        """
        if max_per_trigger and max_bytes:
            raise ValueError("give either a number of files or of bytes")
        if (topic is None) == (pattern is None):
            raise ValueError("give either a topic or a pattern")
        reader = spark.readStream.schema(STORED if topic else TOPIC)
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        if topic:
            return self._named(reader.parquet(self._path(topic)), topic)
        stored = reader.parquet(self.root).select(*TOPIC.fieldNames())
        return stored.filter(F.col("topic").rlike(f"^(?:{pattern})$"))

    def write(self, records: DataFrame, topic: str | None = None, sequence: int = 0) -> None:
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        has = set(records.columns)
        stored = records.select(
            (F.col("key") if "key" in has else F.lit(None)).cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            *([] if topic else ["topic"]),
            F.spark_partition_id().alias("partition"),
            (F.lit(sequence << 33) + row).cast("bigint").alias("offset"),
            F.current_timestamp().alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
        if topic:
            stored.write.mode("overwrite").parquet(f"{self._path(topic)}/write={sequence}")
        else:
            (
                stored.withColumn("write", F.lit(sequence))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("topic", "write")
                .parquet(self.root)
            )
