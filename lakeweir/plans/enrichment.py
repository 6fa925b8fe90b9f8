"""The streaming jobs with their databases and brokers: publish results, keep averages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeweir.config import JdbcConfig
from lakeweir.functions.records import to_records
from lakeweir.operators.joins import BROADCAST_BYTES
from lakeweir.plans.topic_jobs import Topics, publish_table
from lakeweir.schemas import AVERAGES_DDL
from lakeweir.sinks.jdbc import write_jdbc
from lakeweir.sources.jdbc import Split, read_jdbc
from lakeweir.streaming.enriched import build_enriched_stream
from lakeweir.streaming.run import Sink, StreamRun, fan_out, run_stream

RESULTS = "athlete_event_results"
AVERAGES = "athlete_enriched_agg"
PUBLISH_PARTITIONS = 20


def publish_results(
    spark: SparkSession,
    db: JdbcConfig,
    topics: Topics,
    table: str,
    topic: str = RESULTS,
    split: Split | None = None,
    partitions: int | None = None,
) -> None:
    """A database table as messages. Separate from the stream, so a restart sends nothing twice.

    With a ``split`` the scan is parallel already. Without one the rows of the one connection are
    dealt over ``PUBLISH_PARTITIONS`` tasks, if ``partitions`` says nothing else.
    """
    if partitions is None and split is None:
        partitions = PUBLISH_PARTITIONS
    publish_table(read_jdbc(spark, db, table, split), topics, topic, partitions)


def topic_sink(topics: Topics, topic: str) -> Sink:
    return lambda batch, batch_id: topics.write(to_records(batch), topic, batch_id)


def table_sink(db: JdbcConfig, table: str, connections: int | None = None) -> Sink:
    def append(batch: DataFrame, batch_id: int) -> None:
        write_jdbc(batch, db, table, AVERAGES_DDL, connections=connections)

    return append


def run_enrichment(
    spark: SparkSession,
    topics: Topics,
    bio: DataFrame,
    sinks: list[Sink],
    checkpoint: str,
    topic: str = RESULTS,
    max_per_trigger: int | None = None,
    bio_copy: str | None = None,
    broadcast_limit: int = BROADCAST_BYTES,
    max_bytes: int | None = None,
    **run: object,
) -> StreamRun:
    """Messages joined with ``bio``, averaged, and sent to every sink.

    What the join needs of ``bio`` is stored once;
    otherwise each micro-batch would read the database table anew. A run that goes on from a
    checkpoint has averages of that copy in its state, so the copy lies beside the checkpoint
    (``bio_copy``) and is used again. To refresh it, remove both.
    """
    records = topics.read_stream(
        spark, topic, max_per_trigger=max_per_trigger, max_bytes=max_bytes
    )
    stream = build_enriched_stream(
        records,
        bio,
        backlog=topics.read(spark, topic),
        broadcast_limit=broadcast_limit,
        bio_copy=bio_copy or f"{checkpoint.rstrip('/')}-bio",
    )
    return run_stream(stream, fan_out(*sinks), checkpoint, **run)
