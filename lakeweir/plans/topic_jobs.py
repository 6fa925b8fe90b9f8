"""Jobs over topics: publish, mirror, lines in and out, offsets, comparison."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.functions.records import to_records
from lakeweir.operators.joins import BROADCAST_BYTES, fits_broadcast
from lakeweir.session import scratch_path
from lakeweir.sinks.files import write_parquet
from lakeweir.sources.files import read_line_stream
from lakeweir.sources.topics import KafkaTopics, Offsets, ParquetTopics
from lakeweir.streaming.run import StreamRun, run_stream, wait_for

Topics = KafkaTopics | ParquetTopics
POSITION = ("topic", "partition", "offset")
RANGE_OFFSETS = 1 << 16  # offsets whose messages have one digest; sums of 32 bits each stay far within 64


def publish_table(
    df: DataFrame, topics: Topics, topic: str, partitions: int | None = None, sequence: int = 0
) -> None:
    """Every row as one JSON message.

    ``partitions`` redistributes the rows first, which is a full shuffle; leave
    it out when the scan is already parallel enough.
    """
    spread = df.repartition(partitions) if partitions else df
    topics.write(to_records(spread), topic, sequence)


def mirror_topics(
    spark: SparkSession,
    source: Topics,
    target: Topics,
    alias: str,
    checkpoint: str,
    pattern: str = ".*",
    target_alias: str | None = None,
    max_per_trigger: int | None = None,
    **run: object,
) -> StreamRun:
    """Copy topics matching ``pattern`` to ``<alias>.<topic>``, key and value unchanged.

    When mirrors run in both directions, ``target_alias`` keeps topics that
    came from the target from going back to it.
    """
    messages = source.read_stream(spark, pattern=pattern, max_per_trigger=max_per_trigger)
    if target_alias:
        returned = rf"^(?:[^.]+\.)*{re.escape(target_alias)}\."
        messages = messages.filter(~F.col("topic").rlike(returned))
    renamed = messages.select("key", "value", F.concat(F.lit(f"{alias}."), "topic").alias("topic"))

    def send(batch: DataFrame, batch_id: int) -> None:
        target.write(batch, None, batch_id)

    return run_stream(renamed, send, checkpoint, output_mode="append", **run)


def lines_to_topic(
    spark: SparkSession,
    path: str,
    topics: Topics,
    topic: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    **run: object,
) -> StreamRun:
    """Every line of the text files below ``path`` becomes a message."""

    def send(batch: DataFrame, batch_id: int) -> None:
        topics.write(batch, topic, batch_id)

    lines = read_line_stream(spark, path, max_files_per_trigger)
    return run_stream(lines, send, checkpoint, output_mode="append", **run)


def topic_to_lines(
    spark: SparkSession,
    topics: Topics,
    topic: str,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    timeout: float | None = None,
    max_per_trigger: int | None = None,
) -> bool:
    """Every message becomes a line below ``path``; the file sink writes each exactly once."""
    messages = topics.read_stream(spark, topic, max_per_trigger=max_per_trigger)
    lines = messages.select(F.col("value").cast("string").alias("value"))
    writer = lines.writeStream.format("text").option("checkpointLocation", checkpoint)
    if trigger is None:
        query = writer.trigger(availableNow=True).start(path)
    else:
        query = writer.trigger(processingTime=trigger).start(path)
    try:
        return wait_for(query, trigger, timeout)
    finally:
        query.stop()


def bounded_read(
    spark: SparkSession,
    topics: Topics,
    topic: str,
    start: Offsets | None = None,
    end: Offsets | None = None,
    max_messages: int | None = None,
) -> DataFrame:
    """Messages between offsets; with ``max_messages`` the first by partition and offset.

    A partition without a bound of its own, where bounds are given, is not read.
    """
    messages = topics.read(spark, topic, start, end)
    if max_messages is None:
        return messages
    return messages.orderBy("partition", "offset").limit(max_messages)


def topic_offsets(messages: DataFrame) -> DataFrame:
    """First offset and next offset of every partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("start_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def content_hash() -> Column:
    """A hash that tells a NULL key from a NULL value; hashing alone skips NULLs."""
    return F.xxhash64(F.col("key").isNull(), "key", F.col("value").isNull(), "value")


def offset_range(size: int) -> Column:
    return F.floor(F.col("offset") / size).alias("range")


def differing_ranges(left: DataFrame, right: DataFrame, range_offsets: int = RANGE_OFFSETS) -> DataFrame:
    """Ranges of offsets (topic, partition, range) whose messages differ in number or content.

    Messages of the left count as 1, those of the right as -1, and so do two sums of 32 bits each of the
    hash of place and content: what cancels out is equal, in any order. Map tasks add up their ranges, so
    one row per task and range is shuffled.
    """
    places = ["topic", "partition", offset_range(range_offsets)]
    part = F.lit((1 << 32) - 1)

    def digests(log: DataFrame, sign: int) -> DataFrame:
        hashed = log.select(*places, F.xxhash64("offset", content_hash()).alias("hash"))
        low, high = F.col("hash").bitwiseAND(part), F.shiftrightunsigned("hash", 32)
        return hashed.groupBy("topic", "partition", "range").agg(
            (sign * F.count("*")).alias("n"),
            (sign * F.sum(low)).alias("low"),
            (sign * F.sum(high)).alias("high"),
        )

    both = digests(left, 1).unionByName(digests(right, -1)).groupBy("topic", "partition", "range")
    sums = both.agg(*[F.sum(c).alias(c) for c in ("n", "low", "high")])
    # A message without a place is equal to none.
    placed = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("range").isNotNull()
    equal = (F.col("n") == 0) & (F.col("low") == 0) & (F.col("high") == 0)
    return sums.filter(~(placed & equal)).select("topic", "partition", "range")


def within_ranges(log: DataFrame, ranges: DataFrame, range_offsets: int) -> DataFrame:
    """Hashes of the messages in ``ranges``; a missing topic, partition or offset is one range of its own."""
    hashed = log.select(*POSITION, content_hash().alias("hash"), offset_range(range_offsets))
    same = [hashed[c].eqNullSafe(ranges[c]) for c in ("topic", "partition", "range")]
    return hashed.join(ranges, same, "left_semi").drop("range")


def copy_differences(
    left: DataFrame,
    right: DataFrame,
    range_offsets: int = RANGE_OFFSETS,
    broadcast_limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Messages that two copies of a log do not share, by topic, partition and offset.

    Digests of offset ranges are compared first. Only messages of ranges that differ are compared one by
    one, and of these only the hash is shuffled. The ranges are stored and, if their measured size is
    within ``broadcast_limit``, broadcast. Both logs are read twice, so they must not change meanwhile.
    A place that a log holds more than once is compared with each message that the other has there,
    unless all of its range is equal.
    """
    spark = left.sparkSession
    path = scratch_path(spark, "ranges")
    write_parquet(differing_ranges(left, right, range_offsets), path)
    ranges = spark.read.parquet(path)
    if fits_broadcast(ranges, broadcast_limit):
        ranges = F.broadcast(ranges)
    position = list(POSITION)
    a = within_ranges(left, ranges, range_offsets).withColumnRenamed("hash", "left_hash")
    b = within_ranges(right, ranges, range_offsets).withColumnRenamed("hash", "right_hash")
    status = (
        F.when(F.col("right_hash").isNull(), "only_left")
        .when(F.col("left_hash").isNull(), "only_right")
        .when(F.col("left_hash") != F.col("right_hash"), "differs")
    )
    return (
        a.join(b, position, "full_outer")
        .select(*position, status.alias("status"))
        .filter(F.col("status").isNotNull())
    )
