"""Streams: messages published from ``events``, joined with ``customer``, averaged."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.records import from_records, to_records
from lakeweir.operators.duplicates import latest_by_key
from lakeweir.operators.joins import enrich
from lakeweir.plans.topic_jobs import publish_table
from lakeweir.queries.base import Query, sql_average, table
from lakeweir.session import scratch_path
from lakeweir.sinks.files import write_batch
from lakeweir.sources.topics import ParquetTopics
from lakeweir.streaming.enriched import build_enriched_stream
from lakeweir.streaming.ledger import BatchLedger
from lakeweir.streaming.run import Sink, fan_out, run_stream

TOPIC = "events"
BATCHES = 3
FILE_ROWS = 100_000  # messages a task takes at once, however few files the table has
KEYS = ("event_type", "c_mktsegment", "c_nationkey")
MEASURES = {"avg_balance": "c_acctbal"}


def state_partitions(spark: SparkSession) -> int:
    """The groups are few, so a quarter of the cores is enough; at most the session's width."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores // 4, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def message_files(events: DataFrame) -> int:
    """One file of messages per file of the table and per ``FILE_ROWS`` rows, and enough for a few
    micro-batches. Rows are counted from the footers of the table's files."""
    return max(BATCHES, len(events.inputFiles()), -(-events.count() // FILE_ROWS))


def published(spark: SparkSession, sf_dir: str) -> ParquetTopics:
    topics = ParquetTopics(scratch_path(spark, "topics"))
    events = table(spark, sf_dir, "events")
    publish_table(events, topics, TOPIC, partitions=message_files(events))
    return topics


def in_batches(spark: SparkSession, sf_dir: str, topics: ParquetTopics) -> DataFrame:
    """The topic as a stream of ``BATCHES`` micro-batches."""
    files = message_files(table(spark, sf_dir, "events"))
    return topics.read_stream(spark, TOPIC, max_per_trigger=-(-files // BATCHES))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal"
    )


def running_averages(
    spark: SparkSession, sf_dir: str, records: DataFrame, **options: object
) -> DataFrame:
    return build_enriched_stream(
        records,
        customers(spark, sf_dir),
        schema=table(spark, sf_dir, "events").schema,
        on="user_id",
        bio_on="c_custkey",
        event_keys=("event_type",),
        bio_keys=("c_mktsegment", "c_nationkey"),
        output_keys=KEYS,
        measures=MEASURES,
        bio_copy=scratch_path(spark, "dim"),
        **options,
    )


def to_folder(path: str) -> Sink:
    return lambda batch, batch_id: write_batch(batch, path, batch_id)


def latest(changes: DataFrame) -> DataFrame:
    return latest_by_key(changes, KEYS).select(*KEYS, *MEASURES)


def topic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = published(spark, sf_dir).read(spark, TOPIC)
    return from_records(messages, table(spark, sf_dir, "events").schema)


def topic_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = published(spark, sf_dir)
    path = scratch_path(spark, "scanned")
    events = from_records(
        in_batches(spark, sf_dir, topics), table(spark, sf_dir, "events").schema
    )
    run_stream(
        events, to_folder(path), scratch_path(spark, "checkpoint"), None, output_mode="append"
    )
    return spark.read.parquet(path).drop("batch_id")


def stream_rows_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ends after a sink took its batch and before that was noted; read back without the repeat."""
    topics = published(spark, sf_dir)
    ledger = BatchLedger(scratch_path(spark, "ledger"))
    schema = table(spark, sf_dir, "events").schema
    attempts = count()

    def append(batch: DataFrame, batch_id: int) -> None:
        attempt = next(attempts)
        topics.write(to_records(batch), "copies", attempt)
        if attempt == 1:
            raise ConnectionError("lost after the messages were sent")

    run_stream(
        from_records(in_batches(spark, sf_dir, topics), schema),
        fan_out(ledger.once("copies", append)),
        scratch_path(spark, "checkpoint"),
        None,
        output_mode="append",
        restarts=1,
    )
    fields = T.StructType([*schema.fields]).add("batch_id", "long").add("attempt", "string")
    sent = from_records(topics.read(spark, "copies"), fields)
    return ledger.taken_once(sent, "copies").drop("batch_id", "attempt")


def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = published(spark, sf_dir)
    path = scratch_path(spark, "joined")
    events = from_records(
        in_batches(spark, sf_dir, topics),
        table(spark, sf_dir, "events").schema,
        keep=["offset"],
    )
    people = customers(spark, sf_dir).withColumnRenamed("c_custkey", "user_id")
    backlog = from_records(topics.read(spark, TOPIC), table(spark, sf_dir, "events").schema)
    # Planned as for a static table too large to broadcast: no micro-batch shuffles it.
    joined = enrich(
        events, people, "user_id", place=F.col("offset"), backlog=backlog, broadcast_limit=0
    ).select(
        "user_id", "fact.event_id", "fact.event_type", "dim.c_mktsegment", "dim.c_acctbal"
    )
    run_stream(
        joined, to_folder(path), scratch_path(spark, "checkpoint"), None, output_mode="append"
    )
    return spark.read.parquet(path).drop("batch_id")


def averaged(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    topics = published(spark, sf_dir)
    path = scratch_path(spark, "averages")
    records = in_batches(spark, sf_dir, topics)
    options["backlog"] = topics.read(spark, TOPIC)
    run_stream(
        running_averages(spark, sf_dir, records, **options),
        to_folder(path),
        scratch_path(spark, "checkpoint"),
        trigger=None,
        state_partitions=state_partitions(spark),
    )
    return latest(spark.read.parquet(path))


def stream_running_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return averaged(spark, sf_dir)


def stream_running_avg_wide_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same averages planned as for a static table too large to broadcast: in buckets."""
    return averaged(spark, sf_dir, broadcast_limit=0)


def stream_fanout_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every micro-batch to a topic and to a table; both hold the same answer."""
    topics = published(spark, sf_dir)
    path = scratch_path(spark, "table")
    averages = running_averages(spark, sf_dir, in_batches(spark, sf_dir, topics))

    def to_topic(batch: DataFrame, batch_id: int) -> None:
        topics.write(to_records(batch), "averages", batch_id)

    run_stream(
        averages,
        fan_out(to_topic, to_folder(path)),
        scratch_path(spark, "checkpoint"),
        trigger=None,
        state_partitions=state_partitions(spark),
    )
    stored = spark.read.parquet(path)
    message = averages.schema.add("batch_id", "long")
    sent = from_records(topics.read(spark, "averages"), message)
    return (
        latest(stored).withColumn("sink", F.lit("table"))
        .unionByName(latest(sent).withColumn("sink", F.lit("topic")))
    )


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish a part, run, stop; publish the rest, go on from the checkpoint."""
    events = table(spark, sf_dir, "events")
    topics = ParquetTopics(scratch_path(spark, "topics"))
    path = scratch_path(spark, "averages")
    checkpoint = scratch_path(spark, "checkpoint")
    early = F.dayofmonth("ts") <= 15
    for sequence, part in enumerate((events.filter(early), events.filter(~early))):
        publish_table(part, topics, TOPIC, sequence=sequence)
        records = topics.read_stream(spark, TOPIC)
        run_stream(
            running_averages(spark, sf_dir, records),
            fan_out(to_folder(path)),
            checkpoint,
            trigger=None,
            state_partitions=state_partitions(spark),
        )
    return latest(spark.read.parquet(path))


def stream_enrich_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table to topic, topic to averages, averages to a topic, and that topic read back."""
    topics = published(spark, sf_dir)
    averages = running_averages(spark, sf_dir, topics.read_stream(spark, TOPIC))

    def to_topic(batch: DataFrame, batch_id: int) -> None:
        topics.write(to_records(batch), "averages", batch_id)

    run_stream(
        averages,
        fan_out(to_topic),
        scratch_path(spark, "checkpoint"),
        trigger=None,
        state_partitions=state_partitions(spark),
    )
    message = averages.schema.add("batch_id", "long")
    return latest(from_records(topics.read(spark, "averages"), message))


AVERAGES_SQL = f"""
    SELECT event_type, c_mktsegment, c_nationkey, {sql_average("c_acctbal")} AS avg_balance
    FROM events JOIN customer ON user_id = c_custkey
    GROUP BY event_type, c_mktsegment, c_nationkey
"""
EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

QUERIES = [
    Query("topic_publish", topic_publish, EVENTS_SQL),
    Query("topic_stream_scan", topic_stream_scan, EVENTS_SQL),
    Query("stream_rows_once", stream_rows_once, EVENTS_SQL),
    Query(
        "stream_static_join",
        stream_static_join,
        """SELECT user_id, event_id, event_type, c_mktsegment, c_acctbal
           FROM events JOIN customer ON user_id = c_custkey""",
    ),
    Query("stream_running_avg", stream_running_avg, AVERAGES_SQL),
    Query("stream_running_avg_wide_dim", stream_running_avg_wide_dim, AVERAGES_SQL),
    Query(
        "stream_fanout_sinks",
        stream_fanout_sinks,
        f"""SELECT *, 'table' AS sink FROM ({AVERAGES_SQL})
            UNION ALL SELECT *, 'topic' AS sink FROM ({AVERAGES_SQL})""",
    ),
    Query("stream_resume", stream_resume, AVERAGES_SQL),
    Query("stream_enrich_end_to_end", stream_enrich_end_to_end, AVERAGES_SQL),
]
