"""Jobs over topics: mirror, lines, envelopes, bounded reads, offsets, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.functions.records import from_envelopes, from_records, json_value, to_envelopes
from lakeweir.plans.topic_jobs import (
    bounded_read,
    copy_differences,
    lines_to_topic,
    mirror_topics,
    topic_offsets,
    topic_to_lines,
)
from lakeweir.queries.base import Query, table
from lakeweir.schemas import TOPIC
from lakeweir.session import scratch_path
from lakeweir.sources.topics import ParquetTopics

PARTITIONS = 8
FIRST_MESSAGES = 500


def numbered(df: DataFrame, topic: Column, number: str) -> DataFrame:
    """Rows as messages whose partition and offset come from a dense row number."""
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        json_value(df).cast("binary").alias("value"),
        topic.alias("topic"),
        F.pmod(number, F.lit(PARTITIONS)).cast("int").alias("partition"),
        F.floor(F.col(number) / PARTITIONS).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    ).select(*TOPIC.fieldNames())


def topic_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events go to one topic per type, customers to another; only the former match."""
    source = ParquetTopics(scratch_path(spark, "cluster-a"))
    target = ParquetTopics(scratch_path(spark, "cluster-b"))
    events = table(spark, sf_dir, "events")
    by_type = F.concat(F.lit("events."), "event_type").alias("topic")
    source.write(events.select(by_type, json_value(events).alias("value")))
    people = table(spark, sf_dir, "customer")
    source.write(people.select(json_value(people).alias("value")), "customers")
    mirror_topics(
        spark,
        source,
        target,
        "A",
        scratch_path(spark, "checkpoint"),
        pattern=r"events\..*",
        trigger=None,
    )
    copied = spark.read.schema(TOPIC).parquet(target.root)
    return from_records(copied, events.schema, keep=["topic"])


def lines_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "texts")
    topics = ParquetTopics(scratch_path(spark, "topics"))
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines_to_topic(spark, path, topics, "lines", scratch_path(spark, "checkpoint"), trigger=None)
    lines = topics.read(spark, "lines").select(F.col("value").cast("string").alias("line"))
    return lines.groupBy("line").agg(F.count("*").alias("n"))


def messages_as_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = ParquetTopics(scratch_path(spark, "topics"))
    path = scratch_path(spark, "lines")
    props = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    topics.write(props, "props")
    topic_to_lines(spark, topics, "props", path, scratch_path(spark, "checkpoint"))
    return spark.read.text(path).groupBy("value").agg(F.count("*").alias("n"))


def json_envelope_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    events = table(spark, sf_dir, "events").withColumn("ts", text)
    return from_envelopes(to_envelopes(events), events.schema)


def topic_bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every partition without its first and last messages, more of them from later partitions."""
    topics = ParquetTopics(scratch_path(spark, "topics"))
    events = table(spark, sf_dir, "events")
    stored = numbered(events, F.lit("events"), "event_id")
    stored.drop("topic").write.parquet(f"{topics.root}/topic=events/write=0")
    known = topic_offsets(topics.read(spark, "events")).collect()  # one row per partition
    messages = bounded_read(
        spark,
        topics,
        "events",
        start={r["partition"]: r["start_offset"] + r["partition"] for r in known},
        end={r["partition"]: r["end_offset"] - r["partition"] for r in known},
    )
    return from_records(messages, events.schema, keep=["partition", "offset"])


def topic_first_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first messages of two partitions of a written topic, up to a number."""
    topics = ParquetTopics(scratch_path(spark, "topics"))
    events = table(spark, sf_dir, "events")
    stored = numbered(events, F.lit("events"), "event_id")
    stored.drop("topic").write.parquet(f"{topics.root}/topic=events/write=0")
    messages = bounded_read(spark, topics, "events", {2: 0, 5: 0}, max_messages=FIRST_MESSAGES)
    return from_records(messages, events.schema, keep=["partition", "offset"])


def offsets_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic per type of event, as stored; only partition and offset are read back."""
    topics = ParquetTopics(scratch_path(spark, "topics"))
    events = table(spark, sf_dir, "events")
    stored = numbered(events, F.col("event_type"), "event_id")
    stored.withColumn("write", F.lit(0)).write.partitionBy("topic", "write").parquet(topics.root)
    return topic_offsets(topics.read_all(spark))


def topic_copy_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log against a damaged copy: a type lost, a type altered, values moved into the key, and a
    foreign topic."""
    events = table(spark, sf_dir, "events")
    original = numbered(events, F.lit("events"), "event_id")
    altered = F.when(F.col("event_type") == "click", "view").otherwise(F.col("event_type"))
    damaged = events.filter(F.col("event_type") != "error").withColumn("event_type", altered)
    foreign = table(spark, sf_dir, "supplier")
    moved = F.col("offset") % 7 == 3
    copy = numbered(damaged, F.lit("events"), "event_id")
    copy = copy.withColumns(
        {"key": F.when(moved, F.col("value")), "value": F.when(~moved, F.col("value"))}
    ).unionByName(
        numbered(foreign, F.lit("suppliers"), "s_suppkey")
    )
    return copy_differences(original, copy)


QUERIES = [
    Query(
        "topic_mirror",
        topic_mirror,
        """SELECT event_id, ts, user_id, event_type, value, props,
                  'A.events.' || event_type AS topic FROM events""",
    ),
    Query(
        "lines_to_topic",
        lines_as_messages,
        """SELECT line, count(*) AS n
           FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
           GROUP BY line""",
    ),
    Query(
        "topic_to_lines",
        messages_as_lines,
        "SELECT props AS value, count(*) AS n FROM events GROUP BY props",
    ),
    Query(
        "json_envelope_decode",
        json_envelope_decode,
        """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type,
                  value, props FROM events""",
    ),
    Query(
        "topic_bounded_read",
        topic_bounded_read,
        f"""WITH m AS (SELECT *, (event_id % {PARTITIONS})::int AS "partition",
                              event_id // {PARTITIONS} AS "offset" FROM events),
            b AS (SELECT "partition" AS p, min("offset") + "partition" AS low,
                         max("offset") + 1 - "partition" AS high FROM m GROUP BY "partition")
            SELECT event_id, ts, user_id, event_type, value, props, "partition", "offset"
            FROM m JOIN b ON "partition" = p WHERE "offset" >= low AND "offset" < high""",
    ),
    Query(
        "topic_first_messages",
        topic_first_messages,
        f"""SELECT event_id, ts, user_id, event_type, value, props,
                   (event_id % {PARTITIONS})::int AS "partition", event_id // {PARTITIONS} AS "offset"
            FROM events WHERE event_id % {PARTITIONS} IN (2, 5)
            ORDER BY event_id % {PARTITIONS}, event_id // {PARTITIONS} LIMIT {FIRST_MESSAGES}""",
    ),
    Query(
        "topic_offsets",
        offsets_per_partition,
        f"""SELECT event_type AS topic, (event_id % {PARTITIONS})::int AS "partition",
                   min(event_id // {PARTITIONS}) AS start_offset,
                   max(event_id // {PARTITIONS}) + 1 AS end_offset
            FROM events GROUP BY ALL""",
    ),
    Query(
        "topic_copy_diff",
        topic_copy_diff,
        f"""SELECT 'events' AS topic, (event_id % {PARTITIONS})::int AS "partition",
                   event_id // {PARTITIONS} AS "offset",
                   CASE WHEN event_type = 'error' THEN 'only_left' ELSE 'differs' END AS status
            FROM events
            WHERE event_type IN ('error', 'click') OR event_id // {PARTITIONS} % 7 = 3
            UNION ALL
            SELECT 'suppliers', (s_suppkey % {PARTITIONS})::int, s_suppkey // {PARTITIONS},
                   'only_right' FROM supplier""",
    ),
]
