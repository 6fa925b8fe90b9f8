"""Token counts that follow edits without encoding whole texts again.

``count_tokens`` cuts each text into leaves of ``leaf_words`` words and keeps the leaves' token
counts in a segment tree: node 1 is the whole text, node ``n`` the sum of ``2 n`` and ``2 n + 1``.
``apply_edits`` encodes again only the leaves an edit touches, with the leaf
beside it where an edit reaches the border between two, and updates the sums above them.

Leaves begin with a word, so the character before a leaf is white space, and the ids of a
leaf do not depend on its neighbours, for tokenizers that drop white space. A changed leaf that no longer
ends with white space takes in the next one as context. Other tokenizers are refused.

An edit replaces the characters from ``start`` up to ``stop`` of the text as counted by ``value``;
all edits of a text refer to the text before any of them.

Defined cases: a null text is empty and has no tokens; places outside the text are moved to its
nearest end, a ``stop`` before ``start`` counts as ``start``; null places or values count as 0 and
empty; of edits that overlap the first by (start, stop, value) holds, the others are left out and
counted; equal edits of one text count once; edits of unknown ids do nothing; rows that are equal in
id and text are counted each; edits of an id go to all its texts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.memory import freeing
from lakeweir.llm.tokens import encoder
from lakeweir.llm.words import NOT_SPACE, split

LEAF_WORDS = 64
SPACES = " \t\n\v\f\r"
TREE = "leaf_chars array<int>, tree array<int>"


def tree_of(leaves: np.ndarray) -> np.ndarray:
    """Segment tree of leaf counts; the leaves fill the second half."""
    half = 1 << max(int(np.ceil(np.log2(max(len(leaves), 1)))), 0)
    tree = np.zeros(2 * half, np.int64)
    tree[half : half + len(leaves)] = leaves
    while half > 1:
        half //= 2
        tree[half : 2 * half] = tree[2 * half : 4 * half].reshape(-1, 2).sum(axis=1)
    return tree


def count_rows(path: str, leaf_words: int) -> Callable:
    """From (id, row, text): tokens, characters of each leaf, and the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        if not encode.by_word:
            raise ValueError("token counts by leaves need a tokenizer that drops white space")
        for batch in batches:
            for w in split(batch.column(2), NOT_SPACE):
                sizes = np.concatenate([[0], np.cumsum(encode.word_sizes(w))])
                chars = np.zeros(len(w.raw) + 1, np.int64)
                np.cumsum((w.raw & 0xC0) != 0x80, out=chars[1:])
                leaf_chars, trees = [], []
                for i in range(w.texts):
                    lo, hi = w.first[i], w.first[i + 1]
                    words = np.append(np.arange(lo, hi, leaf_words), hi)
                    if hi == lo:
                        words = np.array([lo, lo])
                    cut = np.concatenate(
                        [w.bounds[i : i + 1], w.start[words[1:-1]], w.bounds[i + 1 : i + 2]]
                    )
                    leaf_chars.append(np.diff(chars[cut]).astype(np.int32))
                    trees.append(tree_of(np.diff(sizes[words])).astype(np.int32))
                part = batch.slice(w.lo, w.texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(leaf_chars, pa.list_(pa.int32())),
                        pa.array(trees, pa.list_(pa.int32())),
                    ],
                    names=["id", "row", "leaf_chars", "tree"],
                )

    return freeing(run)


class Edited:
    """One text with its tree while edits are applied."""

    def __init__(self, text: str, leaf_chars: np.ndarray, tree: np.ndarray, edits: list[dict]):
        self.text, self.chars, self.tree = text, leaf_chars.copy(), tree.copy()
        self.before = int(tree[1])
        self.ends = np.cumsum(leaf_chars)
        self.kept: list[tuple[int, int, str]] = []
        self.ignored = 0
        end = -1
        for start, stop, value in sorted({self.clean(e) for e in edits}):
            if start < end:
                self.ignored += 1
            else:
                self.kept.append((start, stop, value))
                end = max(stop, end)
        self.regions = self.touched()

    def clean(self, edit: dict) -> tuple[int, int, str]:
        size = len(self.text)
        start = min(max(edit["start"] or 0, 0), size)
        return start, max(start, min(edit["stop"] or 0, size)), edit["value"] or ""

    def touched(self) -> list[tuple[int, int, str]]:
        """Runs of leaves (first, last) and their new text."""
        last_leaf = len(self.ends) - 1
        runs: list[list] = []  # first leaf, last leaf, edits
        for edit in self.kept:
            # A place between two leaves belongs to both.
            first = int(np.searchsorted(self.ends, edit[0], side="left"))
            last = min(int(np.searchsorted(self.ends, edit[1], side="right")), last_leaf)
            if runs and first <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], last)
                runs[-1][2].append(edit)
            else:
                runs.append([min(first, last_leaf), last, [edit]])
        done: list[tuple[int, int, str]] = []
        for k, (first, last, edits) in enumerate(runs):
            if done and first <= done[-1][1]:
                continue  # taken in as context
            while True:
                new = self.changed(first, last, edits)
                if last == last_leaf or (new and new[-1] in SPACES) or not new and self.free(first):
                    break
                last += 1
                for other in runs[k + 1 :]:
                    if other[0] <= last and other[2][0] not in edits:
                        edits = edits + other[2]
                        last = max(last, other[1])
            done.append((first, last, new))
        return done

    def free(self, first: int) -> bool:
        """What lies before a leaf ends with white space, or is nothing."""
        start = int(self.ends[first - 1]) if first else 0
        return start == 0 or self.text[start - 1] in SPACES

    def changed(self, first: int, last: int, edits: list) -> str:
        at = int(self.ends[first - 1]) if first else 0
        out = []
        for start, stop, value in edits:
            out += [self.text[at:start], value]
            at = stop
        out.append(self.text[at : int(self.ends[last])])
        return "".join(out)

    def whole(self) -> str:
        return self.changed(0, len(self.ends) - 1, self.kept)

    def update(self, counts: list[int]) -> None:
        """Put the new counts into the leaves and the sums above them."""
        half = len(self.tree) // 2
        for (first, last, new), count in zip(self.regions, counts):
            self.chars[first : last + 1] = 0
            self.tree[half + first : half + last + 1] = 0
            self.chars[first], self.tree[half + first] = len(new), count
            lo, hi = (half + first) // 2, (half + last) // 2
            while lo:
                self.tree[lo : hi + 1] = (
                    self.tree[2 * lo : 2 * hi + 2].reshape(-1, 2).sum(axis=1)
                )
                lo, hi = lo // 2, hi // 2


def edit_rows(path: str, keep_text: bool) -> Callable:
    """From (id, text, leaf_chars, tree, edits): counts before and after, and the new state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            states = [
                Edited(
                    text or "",
                    np.array(chars, np.int64),
                    np.array(tree, np.int64),
                    edits or [],
                )
                for text, chars, tree, edits in zip(*(c.to_pylist() for c in batch.columns[1:]))
            ]
            regions = pa.array([new for s in states for _, _, new in s.regions], pa.string())
            counts = np.concatenate(
                [np.zeros(0, np.int64), *(np.diff(b) for _, _, b in encode.encode(regions))]
            )
            at, fresh = 0, []
            for s in states:
                own = counts[at : at + len(s.regions)].tolist()
                at += len(own)
                s.update(own)
                fresh.append(sum(own))
            arrays = [
                batch.column(0),
                pa.array([s.before for s in states], pa.int64()),
                pa.array([int(s.tree[1]) for s in states], pa.int64()),
                pa.array(fresh, pa.int64()),
                pa.array([s.ignored for s in states], pa.int64()),
                pa.array([s.chars for s in states], pa.list_(pa.int32())),
                pa.array([s.tree for s in states], pa.list_(pa.int32())),
            ]
            names = [
                "id", "n_before", "n_tokens", "n_encoded", "n_ignored", "leaf_chars", "tree",
            ]
            if keep_text:
                arrays.append(pa.array([s.whole() for s in states], pa.string()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return freeing(run)


def count_tokens(
    documents: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_words: int = LEAF_WORDS,
) -> DataFrame:
    """State per document: ``id``, ``row`` (hash of the text), ``leaf_chars`` and ``tree``."""
    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text")
    ).mapInArrow(count_rows(tokenizer, leaf_words), f"id {kind}, row bigint, {TREE}")


def apply_edits(
    documents: DataFrame,
    state: DataFrame,
    edits: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Per document: ``id``, ``n_before``, ``n_tokens`` after its ``edits``, ``n_encoded`` of them
    encoded anew, ``n_ignored`` edits, and the new state. ``keep_text`` adds the edited text.

    ``edits`` has the id column, ``start``, ``stop`` and ``value``.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    texts = documents.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text")
    )
    trees = state.dropDuplicates(["id", "row"]).select(
        F.col("id").alias("s_id"), F.col("row").alias("s_row"), "leaf_chars", "tree"
    )
    lists = edits.groupBy(F.col(id_col).alias("e_id")).agg(
        F.collect_set(F.struct("start", "stop", "value")).alias("edits")
    )
    known = trees.join(lists, F.col("s_id").eqNullSafe(F.col("e_id")), "left")
    own = F.col("id").eqNullSafe(F.col("s_id")) & (F.col("row") == F.col("s_row"))
    schema = f"id {kind}, n_before bigint, n_tokens bigint, n_encoded bigint, n_ignored bigint, {TREE}"
    return (
        texts.join(known, own)
        .select("id", "text", "leaf_chars", "tree", "edits")
        .mapInArrow(edit_rows(tokenizer, keep_text), schema + ", text string" * keep_text)
    )
