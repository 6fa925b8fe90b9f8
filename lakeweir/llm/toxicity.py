"""Toxicity by non-negative positive-unlabelled learning.

There are confirmed toxic examples and unlabelled text, but nobody confirmed any text
as harmless. With the class prior ``prior`` (share of toxic texts), the risk of calling
unlabelled text toxic, less the part that its toxic texts explain, stands in for the
risk on harmless text; kept from falling below zero, as it can on a finite sample:

    prior * risk(P as toxic) + max(0, risk(U as harmless) - prior * risk(P as harmless))

Several linear classifiers over the hashed distinct words of a text are trained in
parallel tasks, each on all positives and its own part of the unlabelled sample. A word
counts if its shares of the two samples differ clearly, so that texts are not
recognized by words of their own. The score is the mean of the classifiers' probabilities.

Both samples are bounded (``max_positive``, ``max_unlabelled``) and chosen by a hash of
the id; scoring covers every word of every text and is a map over the rows.

Defined cases: a null text is empty; an empty text has the classifiers' base score;
of several labels for one id the larger counts; labels without id or value
are not used; without positives or unlabelled text every score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.memory import freeing
from lakeweir.llm.samples import hash_sample
from lakeweir.llm.words import ALNUM_LOWER, Words, hash_words, split

MAX_POSITIVE = 4_000
MAX_UNLABELLED = 24_000
BAGS = 4
BITS = 18
BUCKETS = 1 << BITS
LEAST_TEXTS = 4  # positives that must have a word
LEAST_Z = 7.0  # standard errors between a word's shares of positives and unlabelled texts
STEPS = 600
RATE = 0.1
L2 = 2e-5


def word_buckets(w: Words) -> np.ndarray:
    h, _ = hash_words(w)
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (bag, positive, text): bag, positive and the distinct word buckets of the text."""
    for batch in batches:
        for w in split(batch.column(2), ALNUM_LOWER, lower=True):
            pairs = np.unique(w.text_of_word() * BUCKETS + word_buckets(w))
            bounds = np.searchsorted(pairs, np.arange(w.texts + 1) * BUCKETS)
            words = pa.ListArray.from_arrays(
                pa.array(bounds.astype(np.int32)), pa.array((pairs % BUCKETS).astype(np.int32))
            )
            part = batch.slice(w.lo, w.texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), words], names=["bag", "positive", "words"]
            )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit(
    words: list[np.ndarray], positive: np.ndarray, prior: float, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets, their weights and the bias of one classifier; logistic loss, Adam."""
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_unl:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    text = np.repeat(np.arange(len(words)), [len(x) for x in words])
    bucket = np.concatenate(words)
    seen = np.bincount(bucket[positive[text]], minlength=BUCKETS)
    share = np.bincount(bucket[~positive[text]], minlength=BUCKETS) / n_unl
    error = np.sqrt(np.maximum(share, 1 / n_unl) * (1 / n_pos + 1 / n_unl))
    telling = np.abs(seen / n_pos - share) >= LEAST_Z * error
    used = np.flatnonzero(telling & (seen >= LEAST_TEXTS))
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    keep = column[bucket] >= 0
    text, column = text[keep], column[bucket[keep]]
    weights, bias = np.zeros(len(used)), np.log(prior / (1 - prior))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, steps + 1):
        g = np.bincount(text, weights=weights[column], minlength=len(words)) + bias
        p = sigmoid(g)
        as_harmless = np.logaddexp(0, g)  # loss of calling a text harmless
        rest = as_harmless[~positive].mean() - prior * as_harmless[positive].mean()
        # Slopes of the losses: p for calling harmless, p - 1 for calling toxic.
        slope = np.where(positive, -prior * p / n_pos, p / n_unl)
        if rest >= 0:
            slope[positive] += prior * (p[positive] - 1) / n_pos
        else:  # the sample is fitted below what is possible: go back
            slope = -slope
        grad = np.empty(len(used) + 1)
        grad[:-1] = np.bincount(column, weights=slope[text], minlength=len(used)) + L2 * weights
        grad[-1] = slope.sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return used, weights, float(bias)


def train(
    documents: DataFrame,
    labels: DataFrame,
    unlabelled: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    prior: float | None = None,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    bags: int = BAGS,
) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Classifiers from the positives among ``labels`` and the texts of ``unlabelled``.

    ``unlabelled`` is all of ``documents`` if not given; it may hold the positives too.
    ``prior`` is taken from the labels if not given.
    """
    known = (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    if prior is None:
        prior = known.agg(F.avg("label")).collect()[0][0] or 0.0
    prior = min(max(prior, 1e-4), 0.9)
    positives = F.broadcast(hash_sample(known.filter("label = 1"), "label_id", max_positive))
    text = F.col(text_col).alias("text")
    confirmed = (
        documents.select(F.col(id_col).alias("id"), text)
        .join(positives, F.col("id") == F.col("label_id"))
        .select(F.explode(F.array(*map(F.lit, range(bags)))).alias("bag"), F.lit(True), "text")
    )
    unlabelled = documents if unlabelled is None else unlabelled
    bag = F.pmod(F.xxhash64(F.col(id_col), F.lit("bag")), F.lit(bags)).cast("int")
    others = hash_sample(unlabelled, id_col, max_unlabelled).select(bag, F.lit(False), text)
    rows = confirmed.union(others).mapInArrow(
        bucket_rows, "bag int, positive boolean, words array<int>"
    )

    def fit_bag(rows: pd.DataFrame) -> pd.DataFrame:
        words = [np.asarray(x, np.int64) for x in rows["words"]]
        used, weights, bias = fit(words, rows["positive"].to_numpy(bool), prior)
        return pd.DataFrame({"used": [used], "weights": [weights], "bias": [bias]})

    fitted = rows.groupBy("bag").applyInPandas(
        fit_bag, "used array<bigint>, weights array<double>, bias double"
    )
    return [
        (np.array(r["used"], np.int64), np.array(r["weights"]), r["bias"]) for r in fitted.collect()
    ]


def score_rows(models: list[tuple[np.ndarray, np.ndarray, float]]) -> Callable:
    used = np.zeros(BUCKETS, bool)
    table = np.zeros((max(len(models), 1), BUCKETS), np.float32)
    for k, (buckets, weights, _) in enumerate(models):
        used[buckets] = True
        table[k, buckets] = weights
    biases = [bias for _, _, bias in models] or [0.0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in split(batch.column(1), ALNUM_LOWER, lower=True):
                bucket = word_buckets(w)
                keep = used[bucket]
                pairs = np.unique(w.text_of_word()[keep] * BUCKETS + bucket[keep])
                text, bucket = pairs // BUCKETS, pairs % BUCKETS
                score = np.zeros(w.texts)
                for weights, bias in zip(table, biases):
                    total = np.bincount(text, weights=weights[bucket], minlength=w.texts)
                    score += sigmoid(total + bias)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.lo, w.texts), pa.array(score / len(biases))],
                    names=["id", "score"],
                )

    return freeing(run)


def score_toxicity(
    documents: DataFrame,
    models: list[tuple[np.ndarray, np.ndarray, float]],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: ``id`` and ``score`` from 0 (harmless) to 1 (toxic)."""
    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(
        score_rows(models), f"id {kind}, score double"
    )
