"""A ledger of the micro-batches that each sink has taken whole."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.operators.joins import BROADCAST_BYTES, fits_broadcast
from lakeweir.operators.metrics import log
from lakeweir.sinks.files import exists, is_stored
from lakeweir.streaming.run import Sink

ATTEMPT = "attempt"
ENTRY = "attempt string, rows bigint"


@dataclass(frozen=True)
class BatchLedger:
    """Entries ``<path>/sink=<name>/batch_id=<id>``, each with the attempt that counts and its rows.

    An entry is written after its sink has taken the batch. A batch that comes again is skipped where
    it has an entry. Where a run ended between sink and entry, the sink gets the batch
    twice, as two attempts; the entry names the later one, and readers keep its rows alone.
    The ledger belongs to a checkpoint: a stream that starts anew needs a new one.
    """

    path: str

    def _entries(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/sink={name}"

    def once(self, name: str, sink: Sink) -> Sink:
        """``sink`` with an ``attempt`` column in its rows, for use within ``fan_out``."""

        def write(batch: DataFrame, batch_id: int) -> None:
            entry = f"{self._entries(name)}/batch_id={batch_id}"
            if is_stored(batch, entry):
                log.info("%s has batch %d already", name, batch_id)
                return
            attempt = uuid.uuid4().hex
            sink(batch.withColumn(ATTEMPT, F.lit(attempt)), batch_id)
            row = batch.sparkSession.createDataFrame([(attempt, batch.count())], ENTRY)
            row.coalesce(1).write.mode("overwrite").json(entry)

        return write

    def entries(self, spark: SparkSession, name: str) -> DataFrame:
        """``batch_id``, ``attempt`` and ``rows`` of each batch that the sink has taken."""
        schema = f"{ENTRY}, batch_id bigint"
        path = self._entries(name)
        if not exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json(path)

    def taken_once(
        self, rows: DataFrame, name: str, broadcast_limit: int = BROADCAST_BYTES
    ) -> DataFrame:
        """Of what was read back from a sink, the rows of the attempts that count.

        Rows need ``batch_id`` and ``attempt``. Those of a batch without an entry are left out until
        it has one.
        """
        entries = self.entries(rows.sparkSession, name).select("batch_id", ATTEMPT)
        if fits_broadcast(entries, broadcast_limit):
            entries = F.broadcast(entries)
        return rows.join(entries, ["batch_id", ATTEMPT], "left_semi")
