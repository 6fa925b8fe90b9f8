"""Benchmark decontamination by winnowing.

Of every window of ``window`` words the least hash of its ``gram``-word runs is
the window's fingerprint, so two texts that share a window share a fingerprint:
no shared span of ``window`` words or more is missed. Fingerprints of the
benchmark make a bitmap of fixed size, which selects the windows of documents
that can match at all; these are extended to the whole window, and joined with
the benchmark's windows on 128 bits of hash. Items with fewer words than
a window are one window of their own length.

Defined cases: a null or empty text has no words; a benchmark item without words
is never found; items that repeat an id count as one item; items without id are found like
others, count as one item and are one null in ``items``; rows of documents are
kept apart even if they repeat an id or are equal; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.bitmaps import build_bitmap, perhaps_in
from lakeweir.llm.memory import freeing
from lakeweir.llm.storage import Workspace
from lakeweir.llm.words import ALNUM_LOWER, hash_words, mix, ngrams, signed, split, window_minima
from lakeweir.operators.joins import SALT, fits_broadcast, spread_hot_keys

WINDOW = 10
GRAM = 5
# Above this many bytes the benchmark's windows are shuffled instead of broadcast.
BROADCAST_BYTES = 32 << 20

WINDOWS = pa.schema(
    [
        ("row", pa.int64()),
        ("n_words", pa.int64()),
        ("start", pa.int64()),
        ("size", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("print", pa.int64()),
    ]
)
WINDOWS_DDL = (
    "row bigint, n_words bigint, start bigint, size bigint, h1 bigint, h2 bigint, print bigint"
)


def short_print(h1: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of a whole short item of ``size`` words."""
    return mix(h1 + np.uint64(size))


def windows_of(
    texts: pa.Array, window: int, gram: int, sizes: list[int], whole_items: bool
) -> Iterator[tuple[int, np.ndarray, list[tuple]]]:
    """Per chunk: first text, words per text, and windows as (text, start, size, h1, h2, print).

    ``whole_items`` takes a short text as one window. Otherwise windows of the
    lengths in ``sizes`` are taken at every place, as short items may lie anywhere.
    """
    for w in split(texts, ALNUM_LOWER, lower=True):
        counts = np.diff(w.first)
        h1, h2 = hash_words(w)
        room, text = w.room(), w.text_of_word()
        begin = np.arange(len(room)) - w.first[text]
        found = []
        least, _ = window_minima(ngrams(h1, gram), window - gram + 1)
        at = np.flatnonzero(room >= window)
        if len(at):
            found.append(
                (text[at], begin[at], window, ngrams(h1, window)[at], ngrams(h2, window)[at],
                 least[at])
            )
        for size in range(1, window) if whole_items else sizes:
            fits = (room == size) & (begin == 0) if whole_items else room >= size
            at = np.flatnonzero(fits)
            if len(at):
                a, b = ngrams(h1, size)[at], ngrams(h2, size)[at]
                found.append((text[at], begin[at], size, a, b, short_print(a, size)))
        yield w.lo, counts, found


def window_rows(
    window: int, gram: int, sizes: list[int], bitmap: Broadcast | None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function from (id, text) to ``id`` and ``WINDOWS``.

    With a bitmap: a row for each text, and one for each of its windows that the bitmap
    lets through. Without: a row for each window of the items.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        known = bitmap.value if bitmap else None
        for batch in batches:
            ids = batch.column(0)
            for lo, counts, found in windows_of(batch.column(1), window, gram, sizes, not bitmap):
                n = len(counts)
                parts = []
                if bitmap:
                    parts.append((np.arange(n), None, None, None, None, None))
                for text, start, size, h1, h2, fingerprint in found:
                    if bitmap:
                        keep = perhaps_in(known, fingerprint)
                        text, start, h1, h2 = text[keep], start[keep], h1[keep], h2[keep]
                        fingerprint = fingerprint[keep]
                    parts.append(
                        (text, start, np.full(len(text), size), signed(h1), signed(h2),
                         signed(fingerprint))
                    )
                for text, *columns in parts:
                    arrays = [
                        ids.take(pa.array(lo + text)),
                        pa.array(row + lo + text),
                        pa.array(counts[text]),
                    ]
                    arrays += [
                        pa.nulls(len(text), pa.int64()) if c is None else pa.array(c.astype(np.int64))
                        for c in columns
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", *WINDOWS.names])
            row += batch.num_rows

    return freeing(run)


def find_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Per document: ``id``, ``n_words``, ``items`` found in it, and the ``spans`` of words hit.

    ``spans`` are half-open and do not touch each other; ``n_hit`` is their total length.
    """
    work = Workspace(documents.sparkSession, "decontamination")
    kind = benchmark.schema[item_col].dataType.simpleString()
    item_windows = (
        benchmark.select(item_col, item_text_col)
        .mapInArrow(window_rows(window, gram, [], None), f"id {kind}, {WINDOWS_DDL}")
        .select(F.col("id").alias("item"), "size", "h1", "h2", "print")
        .distinct()
    )
    item_windows = work.store(item_windows, "items")
    bitmap = build_bitmap(item_windows, "print")
    sizes = [
        r["size"] for r in item_windows.select("size").distinct().collect() if r["size"] < window
    ]
    # Equal windows have equal fingerprints, so these rows are distinct without them. A null
    # item is an item too, so a match is told by a flag.
    known = item_windows.select("item", "size", "h1", "h2").withColumn("match", F.lit(True))
    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(id_col, text_col).mapInArrow(
        window_rows(window, gram, sizes, bitmap), f"id {kind}, {WINDOWS_DDL}"
    )
    if fits_broadcast(known, broadcast_bytes):
        hits = rows.drop("print").join(F.broadcast(known), ["size", "h1", "h2"], "left")
    else:
        hits = shuffled_hits(work.store(rows.drop("print"), "windows"), known)
    span = F.struct(F.col("start"), (F.col("start") + F.col("size")).alias("stop"))
    # collect_set leaves nulls out.
    no_id = F.bool_or(F.col("match") & F.col("item").isNull())
    null_item = F.lit(None).cast(known.schema["item"].dataType)
    without_id = F.when(no_id, F.array(null_item)).otherwise(F.slice(F.array(null_item), 1, 0))
    per_row = hits.groupBy("row").agg(
        F.first("id").alias("id"),
        F.first("n_words").alias("n_words"),
        F.concat(F.collect_set("item"), without_id).alias("items"),
        F.collect_set(F.when(F.col("match"), span)).alias("found"),
    )
    words = F.flatten(F.transform("found", lambda s: F.sequence(s["start"], s["stop"] - 1)))
    hit = per_row.withColumn("hit", F.sort_array(F.array_distinct(words)))
    return hit.select(
        "id",
        "n_words",
        F.size("hit").cast("bigint").alias("n_hit"),
        "items",
        spans_of("hit").alias("spans"),
    )


def shuffled_hits(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of documents and of their windows that are known, joined by a shuffle of windows only.

    The row that stands for a document has no window, so it passes by the join. Windows that very many
    documents or items share are dealt over tasks.
    """
    windows = rows.filter(F.col("start").isNotNull())
    keys = ["size", "h1", "h2"]
    sides = spread_hot_keys(windows, known, "h1", "h1")
    if sides is None:
        found = windows.join(known.hint("merge"), keys)
    else:
        found = sides[0].join(sides[1].hint("merge"), [*keys, SALT]).drop(SALT)
    return found.unionByName(rows.filter(F.col("start").isNull()), allowMissingColumns=True)


def spans_of(hit: str) -> Column:
    """Sorted places without repeats as spans that neither overlap nor touch."""
    places = F.col(hit)

    def ends(step: int) -> Column:
        # ``get`` gives null outside of the array.
        return F.filter(
            places, lambda x, i: ~F.get(places, i + step).eqNullSafe(x + step)
        )

    return F.zip_with(
        ends(-1), ends(1), lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop"))
    )
