"""Packing by concatenating and cutting.

Pass 1 encodes the texts where they lie and stores ids with the number of
ids before them in their task. The totals of the tasks, one row each, are summed
up in order, which gives every task its place in the one long row of all ids. Pass 2
cuts that row every ``length`` ids: a document that crosses a cut becomes several
pieces, one per sequence. Only the last sequence is short, so padding is below one
sequence for the whole corpus. No text or id is shuffled.

Defined cases: a null or empty text is its end id alone; repeated rows are packed each for
itself; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.llm.memory import freeing
from lakeweir.llm.storage import Workspace
from lakeweir.llm.tokens import encoder
from lakeweir.llm.words import chunks

LENGTH = 4096


def binary(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Slices of an array of ids as binary values."""
    offsets = (bounds * flat.itemsize).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, buffers)


def encode_rows(path: str, end_id: int) -> Callable:
    """From (id, text): the task, the ids before the text in its task, and the text's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), 0
        encode = encoder(path, end_id).encode
        for batch in batches:
            for lo, flat, bounds in encode(batch.column(1)):
                n = len(bounds) - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, n),
                        pa.array(np.full(n, task, np.int32)),
                        pa.array(before + bounds[:-1]),
                        pa.array(np.diff(bounds)),
                        binary(flat, bounds),
                    ],
                    names=["id", "task", "before", "n", "ids"],
                )
                before += len(flat)

    return freeing(run)


def piece_rows(length: int) -> Callable:
    """From (id, place, n, ids): pieces that do not cross a multiple of ``length``.

    Each text has an id at least, so the bytes of an id can be told from the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            offsets = np.frombuffer(ids.buffers()[1], np.int32)
            offsets = offsets[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
            data = np.frombuffer(ids.buffers()[2], np.uint8)
            for lo, hi in chunks(offsets):
                part = batch.slice(lo, hi - lo)
                place, n = part.column(1).to_numpy(), part.column(2).to_numpy()
                dtype = f"<u{(offsets[hi] - offsets[lo]) // n.sum()}"
                flat = data[offsets[lo] : offsets[hi]].view(dtype).astype("<u4")
                first = place // length
                pieces = (place + n - 1) // length - first + 1
                doc = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = first[doc] + nth
                begin = np.maximum(place[doc], sequence * length)
                size = np.minimum((place + n)[doc], (sequence + 1) * length) - begin
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(doc)),
                        pa.array(begin - place[doc]),
                        pa.array(size),
                        pa.array(n[doc]),
                        pa.array(sequence),
                        pa.array(begin - sequence * length),
                        binary(flat, np.concatenate([[0], np.cumsum(size)])),
                    ],
                    names=["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
                )

    return freeing(run)


def pack(
    documents: DataFrame,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
) -> DataFrame:
    """Pieces of documents: ``id``, ``start`` in the document, ``length``, ``doc_tokens``,
    ``sequence_id``, ``offset`` in the sequence and ``ids`` as unsigned 32-bit little-endian.

    ``tokenizer`` is the path of a tokenizer file, present on every executor.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    encoded = documents.select(id_col, text_col).mapInArrow(
        encode_rows(tokenizer, end_id), f"id {kind}, task int, before bigint, n bigint, ids binary"
    )
    stored = Workspace(documents.sparkSession, "packing").store(encoded, "ids")
    # One row per task of pass 1: few enough for one task and for a broadcast.
    ordered = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        stored.groupBy("task")
        .agg(F.sum("n").alias("total"))
        .select("task", F.coalesce(F.sum("total").over(ordered), F.lit(0)).alias("base"))
    )
    placed = stored.join(F.broadcast(bases), "task").select(
        "id", (F.col("base") + F.col("before")).alias("place"), "n", "ids"
    )
    return placed.mapInArrow(
        piece_rows(length),
        f"id {kind}, start bigint, length bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, ids binary",
    )
