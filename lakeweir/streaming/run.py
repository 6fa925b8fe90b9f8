"""Start, bound and restart a stream; fan a micro-batch out to several sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeweir.operators.metrics import log, log_sample

TRIGGER = "5 seconds"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
Sink = Callable[[DataFrame, int], None]


def fan_out(*sinks: Sink) -> Sink:
    """One function for ``foreachBatch`` that writes a micro-batch to every sink.

    The batch is computed once and kept while the sinks read it. An empty
    batch is skipped. A sink that fails stops the query, so the batch is not
    committed and comes again; sinks must therefore bear a repeated batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist()
        try:
            if rows.isEmpty():
                return
            log_sample(rows, f"batch {batch_id}")
            for sink in sinks:
                sink(rows, batch_id)
        finally:
            rows.unpersist()

    return write


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the time of a ``start()``, which copies them into the query."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class UnfinishedStream(RuntimeError):
    """A run that had to take all there was ended before it had."""


@dataclass(frozen=True)
class StreamRun:
    """How a bounded run ended. ``finished`` is False if the time ran out first."""

    finished: bool
    last_batch: int | None
    restarts: int


def start_stream(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    output_mode: str = "update",
    state_partitions: int | None = None,
    state_store: str | None = None,
) -> StreamingQuery:
    """Start ``df`` into ``sink``; without a trigger it takes what is there and ends.

    ``state_partitions`` is fixed by the first start: the checkpoint remembers
    it. Pass ``ROCKSDB`` as ``state_store`` when the keys outgrow memory.
    """
    values = {}
    if state_partitions:
        values["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store:
        values["spark.sql.streaming.stateStore.providerClass"] = state_store
    writer = (
        df.writeStream.foreachBatch(sink)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if trigger is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=trigger)
    with _settings(df.sparkSession, values):
        return writer.start()


def wait_for(query: StreamingQuery, trigger: str | None, timeout: float | None) -> bool:
    """Whether the query ended within ``timeout`` seconds; without one, wait for its end."""
    if timeout is None:
        query.awaitTermination()
        return True
    finished = bool(query.awaitTermination(timeout))
    if not finished and trigger is None:
        raise UnfinishedStream(f"input was left after {timeout} seconds")
    return finished


def run_stream(
    df: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    timeout: float | None = None,
    output_mode: str = "update",
    state_partitions: int | None = None,
    state_store: str | None = None,
    restarts: int = 0,
) -> StreamRun:
    """Run to the end, or for at most ``timeout`` seconds if that is given.

    With a trigger a stream has no end, and stopping it at its limit is how it is meant to end.
    Without a trigger all that is there has to be taken: if the limit cuts that short,
    ``UnfinishedStream`` is raised. A failed query is started again from its checkpoint up to ``restarts``
    times; after that the error is raised.
    """
    used = 0
    while True:
        query = start_stream(
            df, sink, checkpoint, trigger, output_mode, state_partitions, state_store
        )
        try:
            finished = wait_for(query, trigger, timeout)
            progress = query.lastProgress
            last = progress.batchId if progress else None
            log.info("stream %s at batch %s", "ended" if finished else "ran out of time", last)
            return StreamRun(finished, last, used)
        except StreamingQueryException as error:
            if used >= restarts:
                raise
            used += 1
            log.warning("stream failed, restart %d of %d: %s", used, restarts, error)
        finally:
            query.stop()
