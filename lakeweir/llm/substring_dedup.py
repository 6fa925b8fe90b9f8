"""Removal of long repeated word sequences over a compacted de Bruijn graph.

Each window of ``window`` words is named by its seed, the least hash among its
``gram``-word runs. Consecutive windows with the same seed occurrence form one
edge of the graph, the path that passes through the seed; an edge holds about
eight windows, so the graph has about an eighth of the corpus's words as edges.

1. One aggregate over all edges finds the seeds that occur again, and whether all
   edges through a seed are equal (the path does not branch) or not.
2. Edges through seeds that never branch stay compacted: all their windows occur
   together wherever one does. Edges through branching seeds, at the ends of
   repeated passages, are expanded to single windows. The seeds reach this pass
   as bitmaps of fixed size; what they let through in error is decided by 3.
3. Edges and windows meet by 128 bits of content. All but the one with the smallest
   source coordinates are repeats. A batch first settles those whose earlier
   occurrence lies in the batch itself, so a passage in a third of all documents
   reaches its group as one row per batch.
4. Coordinates of repeats join the texts, where the words they cover are removed.

Windows are judged on the input, not on what is left.

Defined cases: a null or empty text has no words and nothing to remove; a text of
fewer words than a window is kept; ids are integers, a null id comes first; rows
that are equal in id and text are the same place, none of them repeats the other;
rows with one id and different texts are one document's texts, the earlier start
wins, then the smaller text hash. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.llm.bitmaps import build_bitmap, perhaps_in
from lakeweir.llm.memory import freeing
from lakeweir.llm.storage import Workspace
from lakeweir.llm.words import (
    M1,
    NOT_SPACE,
    STEP,
    Words,
    hash_words,
    mix,
    ngrams,
    signed,
    split,
    window_minima,
)

WINDOW = 20
GRAM = 5
FIRST_ID = np.iinfo(np.int64).min


class Edges:
    """Edges of a run of texts: seed, first window (as a word), number of windows, content."""

    def __init__(self, w: Words, window: int, gram: int):
        self.h1, self.h2 = hash_words(w)
        least, place = window_minima(ngrams(self.h1, gram), window - gram + 1)
        at = np.flatnonzero(w.room() >= window)
        same = np.zeros(len(at), bool)
        same[1:] = (at[1:] == at[:-1] + 1) & (place[at[1:]] == place[at[:-1]])
        head = np.flatnonzero(~same)
        self.start = at[head]
        self.count = np.diff(np.append(head, len(at)))
        self.seed = least[self.start]
        self.run1 = ngrams(self.h1, window)

    def content(self, run: np.ndarray) -> np.ndarray:
        """The first and the last window overlap, so their hashes cover every word between."""
        last = self.start + self.count - 1
        return mix(run[self.start] * M1 + run[last] * STEP + self.count.astype(np.uint64))


def seed_rows(window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in split(batch.column(0), NOT_SPACE):
                edges = Edges(w, window, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(edges.seed)),
                        pa.array(signed(edges.content(edges.run1))),
                    ],
                    names=["seed", "content"],
                )

    return freeing(run)


def place_rows(window: int, gram: int, plain: Broadcast, branching: Broadcast) -> Callable:
    """Coordinates of edges and windows that may repeat.

    ``settled`` rows are known to repeat an earlier place of the same batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.fill_null(batch.column(0).cast(pa.int64()), int(FIRST_ID)).to_numpy()
            row = batch.column(1).to_numpy()
            found = []
            for w in split(batch.column(2), NOT_SPACE):
                edges = Edges(w, window, gram)
                single = perhaps_in(branching.value, edges.seed)
                compact = perhaps_in(plain.value, edges.seed) & ~single
                if not (single.any() or compact.any()):
                    continue
                text = w.text_of_word()
                run2 = ngrams(edges.h2, window)
                head, size = edges.start[single], edges.count[single]
                at = np.repeat(head - np.cumsum(size) + size, size) + np.arange(size.sum())
                places = np.concatenate([edges.start[compact], at])
                key1 = np.concatenate([edges.content(edges.run1)[compact], ~edges.run1[at]])
                key2 = np.concatenate([edges.content(run2)[compact], ~run2[at]])
                count = np.concatenate([edges.count[compact], np.ones(len(at), np.int64)])
                t = text[places]
                found.append((w.lo + t, places - w.first[t], count, key1, key2))
            if not found:
                continue
            text, start, count, key1, key2 = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((row[text], start, ids[text], key2, key1))
            text, start, count, key1, key2 = (
                c[order] for c in (text, start, count, key1, key2)
            )
            head = np.ones(len(text), bool)
            head[1:] = (key1[1:] != key1[:-1]) | (key2[1:] != key2[:-1])
            first = np.flatnonzero(head)[np.cumsum(head) - 1]
            later = (ids[text] != ids[text[first]]) | (start != start[first])
            later |= row[text] != row[text[first]]
            opened = [
                ids[text[head]], row[text[head]], start[head], count[head],
                signed(key1[head]), signed(key2[head]), np.zeros(head.sum(), bool),
            ]
            text, start, count = merged(text[later], start[later], count[later])
            own = mix((row[text].astype(np.uint64) ^ start.astype(np.uint64) * M1).copy())
            settled = [
                ids[text], row[text], start, count,
                signed(own), signed(own), np.ones(len(text), bool),
            ]
            for columns in (opened, settled):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns],
                    names=["id", "row", "start", "count", "key1", "key2", "settled"],
                )

    return freeing(run)


def merged(text: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple:
    """Runs of windows of a text that follow each other or overlap, as one run."""
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], (start + count)[order]
    if not len(text):
        return text, start, stop
    # Stops grow along a text; a shift per text keeps texts apart.
    lift = text * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    head = np.ones(len(text), bool)
    head[1:] = (text[1:] != text[:-1]) | (start[1:] + lift[1:] > reach[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(text)) - 1
    return text[first], start[first], (reach - lift)[last] - start[first]


def cut(texts: pa.Array, spans: pa.RecordBatch, window: int) -> Iterator[tuple]:
    """Per chunk: first text, words, removed words and kept text of each text.

    ``spans`` has the first words and the numbers of repeated windows as lists.
    """
    for w in split(texts, NOT_SPACE):
        part = spans.slice(w.lo, w.texts)
        starts, counts = part.column(0), part.column(1)
        text = pc.list_parent_indices(starts).to_numpy()
        begin = w.first[text] + starts.flatten().to_numpy()
        stop = begin + counts.flatten().to_numpy() + window - 1
        cover = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, stop, -1)
        gone = np.cumsum(cover)[:-1] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])[w.first]
        yield w.lo, np.diff(w.first), np.diff(removed), joined_words(w, ~gone)


def cut_rows(window: int) -> Callable:
    """From (starts, counts, id, text): words, removed words and kept text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words, removed, kept in cut(batch.column(3), batch.select([0, 1]), window):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(lo, len(words)), pa.array(words), pa.array(removed), kept],
                    names=["id", "n_words", "n_removed", "kept"],
                )

    return freeing(run)


def replace_rows(window: int, text_at: int) -> Callable:
    """From (starts, counts, *columns): the columns, with the text cut where it repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[2:]
            texts = columns[text_at]
            parts = [(n, k) for _, _, n, k in cut(texts, batch.select([0, 1]), window)]
            if parts:
                changed = pa.array(np.concatenate([n for n, _ in parts]) > 0)
                kept = pa.concat_arrays([k for _, k in parts])
                columns[text_at] = pc.if_else(changed, kept.cast(texts.type), texts)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[2:])

    return freeing(run)


def joined_words(w: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    n = len(w.buf) - 8
    mark = np.zeros(n + 1, np.int8)
    start, end = w.start[keep], w.end[keep]
    np.add.at(mark, start, 1)
    np.add.at(mark, end, -1)
    mark = np.cumsum(mark[:-1], dtype=np.int8).view(bool)
    text = w.text_of_word()[keep]
    follows = np.zeros(len(text), bool)
    follows[:-1] = text[1:] == text[:-1]
    out = w.buf[:-8].copy()
    out[end[follows]] = 32
    mark[end[follows]] = True
    length = (end - start) + follows
    size = np.bincount(text, weights=length, minlength=w.texts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    data = pa.py_buffer(out[mark].tobytes())
    kept = pa.Array.from_buffers(
        pa.large_string(), w.texts, [None, pa.py_buffer(offsets.tobytes()), data]
    )
    return kept.cast(pa.string())


def repeated_spans(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """``span_id``, ``span_row``, ``starts`` and ``counts`` of repeated windows of ``texts``
    (id, row, text), for the texts that have any."""
    work = Workspace(texts.sparkSession, "substring-dedup")
    repeated = (
        texts.select("text")
        .mapInArrow(seed_rows(window, gram), "seed bigint, content bigint")
        .groupBy("seed")
        .agg(
            F.count("*").alias("n"),
            (F.min("content") != F.max("content")).alias("branching"),
        )
        .filter("n > 1")
    )
    repeated = work.store(repeated.select("seed", "branching"), "seeds")
    plain = build_bitmap(repeated.filter("not branching"), "seed")
    branching = build_bitmap(repeated.filter("branching"), "seed")
    work.drop(repeated)
    places = texts.mapInArrow(
        place_rows(window, gram, plain, branching),
        "id bigint, row bigint, start bigint, count bigint, "
        "key1 bigint, key2 bigint, settled boolean",
    )
    rank = F.rank().over(Window.partitionBy("key1", "key2").orderBy("id", "start", "row"))
    return (
        places.withColumn("rank", rank)
        .filter("settled or rank > 1")
        .groupBy("id", "row")
        .agg(F.sort_array(F.collect_set(F.struct("start", "count"))).alias("spans"))
        .select(
            F.col("id").alias("span_id"),
            F.col("row").alias("span_row"),
            F.col("spans.start").alias("starts"),
            F.col("spans.count").alias("counts"),
        )
    )


def with_spans(
    documents: DataFrame, id_col: str, text_col: str, window: int, gram: int, columns: list[str]
) -> DataFrame:
    """``columns`` of ``documents`` behind the spans to remove from each."""
    id_, row = F.col(id_col).cast("bigint"), F.xxhash64(F.col(text_col))
    texts = documents.select(id_.alias("id"), row.alias("row"), F.col(text_col).alias("text"))
    spans = repeated_spans(texts, window, gram)
    id_, row = documents[id_col].cast("bigint"), F.xxhash64(documents[text_col])
    here = (F.coalesce(id_, F.lit(int(FIRST_ID))) == spans["span_id"]) & (row == spans["span_row"])
    none = F.array().cast("array<bigint>")
    return documents.join(spans, here, "left").select(
        F.coalesce(spans["starts"], none),
        F.coalesce(spans["counts"], none),
        *(documents[c] for c in columns),
    )


def remove_repeats(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Per document: ``id``, ``n_words``, ``n_removed`` and the ``kept`` words as a text."""
    kind = documents.schema[id_col].dataType.simpleString()
    rows = with_spans(documents, id_col, text_col, window, gram, [id_col, text_col])
    return rows.mapInArrow(
        cut_rows(window), f"id {kind}, n_words bigint, n_removed bigint, kept string"
    )


def cut_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``documents`` with all columns; texts that lose words become their kept words, joined by a
    space, all others stay as they are."""
    rows = with_spans(documents, id_col, text_col, window, gram, documents.columns)
    text_at = documents.columns.index(text_col)
    return rows.mapInArrow(replace_rows(window, text_at), documents.schema)
