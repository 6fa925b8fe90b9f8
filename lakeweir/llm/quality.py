"""Line quality with a linear-chain conditional random field.

Every line of a text is good or bad. Binned measures of the line and of its two
neighbours give its score, a 2 x 2 table the score of following another line. Trained
by maximum likelihood on labelled texts, each line taking the label of its text.
The quality of a text is the mean of its lines' marginal probabilities of being good,
weighted by line length plus one.

The sample to learn from is bounded (``max_train``); scoring covers every line of every
text and is a map over the rows, without a shuffle.

Defined cases: a null text is empty, an empty text is one empty line; of several
labels for one id the larger counts; labels without id or value are not used; without any
labelled text every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.memory import freeing, release
from lakeweir.llm.samples import hash_sample
from lakeweir.llm.words import NOT_SPACE, M1, Words, hash_words, mix, split

MAX_TRAIN = 10_000
STEPS = 150
RATE = 0.15
L2 = 1e-4
BINS = 16
SHARES = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97])
MEASURES = 12
WIDTH = MEASURES * BINS

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_LETTER = _UPPER | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_MARK = NOT_SPACE & ~_LETTER & ~_DIGIT
_STOP = np.isin(_BYTES, [ord(c) for c in ".!?:;"])
# Two counts in one number, so that one running sum counts both.
_PAIR1 = (_LETTER.astype(np.uint64) << np.uint64(32)) | _UPPER.astype(np.uint64)
_PAIR2 = (_DIGIT.astype(np.uint64) << np.uint64(32)) | _MARK.astype(np.uint64)
_LOW = np.uint64(0xFFFFFFFF)


@dataclass
class Lines:
    """Lines of a run of texts: text ``i`` has the lines ``first[i]`` to ``first[i + 1]``."""

    first: np.ndarray
    size: np.ndarray  # bytes
    bins: np.ndarray  # one bin per line and measure


def running(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=out[1:])
    return out


def lines_of(w: Words, bounds: np.ndarray) -> Lines:
    """Lines and their measures; ``bounds`` are the offsets of the texts in the buffer."""
    data = w.buf[:-8]
    breaks = np.flatnonzero(data == 10)
    # A text's first line begins with the text, each further one after a line break.
    texts = len(bounds) - 1
    begin = np.concatenate([bounds[:-1], breaks + 1])
    owner = np.concatenate([np.arange(texts), np.searchsorted(bounds[1:], breaks, side="right")])
    order = np.lexsort((begin, owner))
    begin, owner = begin[order], owner[order]
    first = np.searchsorted(owner, np.arange(texts + 1))
    end = np.empty(len(begin), np.int64)
    end[:-1] = begin[1:] - 1
    end[first[1:] - 1] = bounds[1:]
    size = end - begin

    pair1, pair2 = running(_PAIR1[data]), running(_PAIR2[data])
    a, b = pair1[end] - pair1[begin], pair2[end] - pair2[begin]
    letters, upper = (a >> np.uint64(32)).astype(np.int64), (a & _LOW).astype(np.int64)
    digits, marks = (b >> np.uint64(32)).astype(np.int64), (b & _LOW).astype(np.int64)

    h, _ = hash_words(w)
    word = np.searchsorted(w.start, begin)
    word_end = np.searchsorted(w.start, end)
    words = word_end - word
    line = np.repeat(np.arange(len(begin)), words)
    wordless = pair1[w.end] - pair1[w.start] < np.uint64(1 << 32)
    marked = _MARK[data[w.end - 1]] & _MARK[data[np.maximum(w.end - 2, 0)]] & (w.end - w.start > 1)
    again1, again2 = np.zeros(len(h), bool), np.zeros(len(h), bool)
    again1[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    again2[2:] = (h[2:] == h[:-2]) & (line[2:] == line[:-2])

    def per_word(flag: np.ndarray) -> np.ndarray:
        total = running(flag.astype(np.int64))
        return (total[word_end] - total[word]) / np.maximum(words, 1)

    # Equal lines of one text have equal sums of place-dependent word hashes.
    place = (np.arange(len(h)) - word[line]).astype(np.uint64)
    total = running(mix(h + place * M1))
    content = total[word_end] - total[word]
    order = np.lexsort((content, owner))
    repeated = np.zeros(len(begin), np.int64)
    same = (content[order][1:] == content[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    same &= words[order][1:] > 0
    repeated[order[1:][same]] = 1
    repeated[order[:-1][same]] = 1

    visible = np.maximum(letters + digits + marks, 1)
    last = np.where(words > 0, data[np.maximum(w.end[np.maximum(word_end - 1, 0)] - 1, 0)], 0) \
        if len(w.end) else np.zeros(len(begin), np.int64)
    bins = np.empty((len(begin), MEASURES), np.uint8)
    bins[:, 0] = np.minimum(np.log2(size + 1), BINS - 2)
    bins[:, 1] = np.digitize(letters / visible, SHARES)
    bins[:, 2] = np.digitize(upper / np.maximum(letters, 1), SHARES)
    bins[:, 3] = np.digitize(digits / visible, SHARES)
    bins[:, 4] = np.digitize(marks / visible, SHARES)
    bins[:, 5] = np.minimum(visible / np.maximum(words, 1), BINS - 2)
    bins[:, 6] = np.digitize(per_word(wordless), SHARES)
    bins[:, 7] = np.digitize(per_word(marked), SHARES)
    bins[:, 8] = np.digitize(per_word(again1), SHARES)
    bins[:, 9] = np.digitize(per_word(again2), SHARES)
    bins[:, 10] = _STOP[last]
    bins[:, 11] = repeated
    return Lines(first, size, bins)


def text_lines(texts: pa.Array) -> Iterator[tuple[int, Lines]]:
    """Lines of a string array, a chunk at a time, with the chunk's first text."""
    for w in split(texts, NOT_SPACE):
        yield w.lo, lines_of(w, w.bounds)


def features(lines: Lines) -> np.ndarray:
    """Active features of each line: its own bins, then those of the line before and after."""
    n = len(lines.size)
    own = lines.bins.astype(np.int32) + np.arange(MEASURES, dtype=np.int32) * BINS
    outside = np.arange(MEASURES, dtype=np.int32) * BINS + BINS - 1  # no such line
    before, after = np.empty_like(own), np.empty_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[lines.first[:-1]] = outside
    after[lines.first[1:] - 1] = outside
    out = np.empty((n, 3 * MEASURES), np.int32)
    out[:, :MEASURES] = own
    out[:, MEASURES : 2 * MEASURES] = before + WIDTH
    out[:, 2 * MEASURES :] = after + 2 * WIDTH
    return out


@dataclass
class Crf:
    """Scores of being good: weights of features, and of a line following another (from, to)."""

    weights: np.ndarray
    bias: float
    follow: np.ndarray

    @classmethod
    def blank(cls) -> Crf:
        return cls(np.zeros(3 * WIDTH), 0.0, np.zeros((2, 2)))

    def unary(self, active: np.ndarray) -> np.ndarray:
        return self.weights[active].sum(axis=1) + self.bias


def schedule(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts from the longest to the shortest, and how many have a line ``t``, for each ``t``."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    steps = int(size.max()) if len(size) else 0
    return order, np.searchsorted(-size[order], -np.arange(steps), side="left")


def passes(model: Crf, unary: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of good against bad of the forward and the backward messages.

    All texts advance together, one line at a time.
    """
    order, active = schedule(first)
    a, b = unary.copy(), np.zeros(len(unary))
    (f00, f01), (f10, f11) = model.follow
    head = first[:-1][order]
    for t in range(1, len(active)):
        here = head[: active[t]] + t
        before = a[here - 1]
        a[here] += np.logaddexp(before + f11, f01) - np.logaddexp(before + f10, f00)
    for t in range(len(active) - 2, -1, -1):
        here = head[: active[t + 1]] + t
        after = b[here + 1] + unary[here + 1]
        b[here] = np.logaddexp(after + f11, f10) - np.logaddexp(after + f01, f00)
    return a, b


def marginals(model: Crf, lines: Lines) -> np.ndarray:
    unary = model.unary(features(lines))
    a, b = passes(model, unary, lines.first)
    return 1 / (1 + np.exp(-np.clip(a + b, -60, 60)))


def fit(lines: Lines, labels: np.ndarray, steps: int = STEPS, rate: float = RATE) -> Crf:
    """Maximum likelihood by Adam. ``labels`` has 0 or 1 for each text."""
    model = Crf.blank()
    if not len(labels):
        return model
    active, first = features(lines), lines.first
    y = np.repeat(labels, np.diff(first)).astype(np.int64)
    # Texts count alike, however many lines they have.
    scale = 1.0 / (np.repeat(np.diff(first), np.diff(first)) ** 0.5)
    scale /= scale.sum()
    inner = np.ones(len(y), bool)
    inner[first[:-1]] = False
    to = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[to - 1], y[to]), scale[to])
    state = np.zeros(3 * WIDTH + 5)
    m, v = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        model = Crf(state[5:], state[0], state[1:5].reshape(2, 2))
        unary = model.unary(active)
        a, b = passes(model, unary, first)
        p = 1 / (1 + np.exp(-np.clip(a + b, -60, 60)))
        push = (y - p) * scale
        # Joint probabilities of the labels of two lines in a row.
        joint = np.empty((2, 2, len(to)))
        for s in (0, 1):
            for t in (0, 1):
                joint[s, t] = model.follow[s, t] + s * a[to - 1] + t * (unary[to] + b[to])
        joint = np.exp(joint - joint.max(axis=(0, 1)))
        joint /= joint.sum(axis=(0, 1))
        grad = np.empty_like(state)
        grad[0] = push.sum()
        grad[1:5] = (seen - (joint * scale[to]).sum(axis=2)).ravel()
        grad[5:] = np.bincount(
            active.ravel(), weights=np.repeat(push, active.shape[1]), minlength=3 * WIDTH
        )
        grad[1:] -= L2 * state[1:]
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        state = state + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf(state[5:], state[0], state[1:5].reshape(2, 2))


def line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (text, label): label, bytes and bins of the lines of a text."""
    for batch in batches:
        for lo, lines in text_lines(batch.column(0)):
            n = len(lines.first) - 1
            size = [lines.size[a:b].astype("<i8").tobytes() for a, b in _pairs(lines.first)]
            bins = [lines.bins[a:b].tobytes() for a, b in _pairs(lines.first)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(lo, n), pa.array(size), pa.array(bins)],
                names=["label", "size", "bins"],
            )


def _pairs(first: np.ndarray) -> zip:
    return zip(first[:-1].tolist(), first[1:].tolist())


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
) -> Crf:
    """Fit on about ``max_train`` labelled texts at most, chosen by a hash of the id."""
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    chosen = F.broadcast(hash_sample(known, "label_id", max_train))
    rows = (
        documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(chosen, F.col("id") == F.col("label_id"))
        .select("text", "label")
        .mapInArrow(line_rows, "label int, size binary, bins binary")
        .collect()
    )
    sizes = [np.frombuffer(r["size"], "<i8") for r in rows]
    bins = [np.frombuffer(r["bins"], np.uint8) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sizes], dtype=np.int64)]).astype(int)
    none = np.zeros(0, np.int64)
    lines = Lines(
        first,
        np.concatenate([*sizes, none]),
        np.concatenate([*bins, none.astype(np.uint8)]).reshape(-1, MEASURES),
    )
    try:
        return fit(lines, np.array([r["label"] for r in rows], np.int64))
    finally:
        del rows, sizes, bins, lines
        release()


def text_scores(model: Crf, lines: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text, and probability of being good of each line."""
    good, weight = marginals(model, lines), lines.size + 1.0
    score = np.add.reduceat(good * weight, lines.first[:-1])
    score /= np.add.reduceat(weight, lines.first[:-1])
    return np.clip(score, 0.0, 1.0), good


def score_rows(model: Crf) -> Callable:
    """From (id, text): score and number of lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, lines in text_lines(batch.column(1)):
                n = len(lines.first) - 1
                score, good = text_scores(model, lines)
                bad = np.add.reduceat((good < 0.5).astype(np.int64), lines.first[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, n),
                        pa.array(score),
                        pa.array(np.diff(lines.first)),
                        pa.array(bad),
                    ],
                    names=["id", "score", "n_lines", "n_bad_lines"],
                )

    return freeing(run)


def score_quality(
    documents: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: ``id``, ``score`` from 0 (bad) to 1, ``n_lines`` and ``n_bad_lines``."""
    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(
        score_rows(model), f"id {kind}, score double, n_lines bigint, n_bad_lines bigint"
    )


def filter_rows(model: Crf, text_at: int, least: float) -> Callable:
    """Whole rows whose text scores ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for _, lines in text_lines(batch.column(text_at)):
                score, _ = text_scores(model, lines)
                keep.append(score >= least)
            yield batch.filter(pa.array(np.concatenate([*keep, np.zeros(0, bool)])))

    return freeing(run)


def keep_good(
    documents: DataFrame, model: Crf, least: float, text_col: str = "text"
) -> DataFrame:
    """The rows of ``documents``, all columns as they are, whose text scores ``least`` or more."""
    text_at = documents.columns.index(text_col)
    return documents.mapInArrow(filter_rows(model, text_at, least), documents.schema)
