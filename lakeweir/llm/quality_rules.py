"""Quality rules as a ledger of failure bits.

``evaluate_rules`` measures each text once and stores for every document what it measured and a
bitmask: bit ``k`` is set if rule ``k`` of ``RULES`` failed. Policies are versioned sets of rules,
that is masks, and are applied to the ledger alone: a document is kept if ``bits & mask`` is 0. So a new
policy, or one without a rule (an ablation), costs a pass over integers and no text is read again.
``ablations`` counts documents per bitmask first, a table of at most ``2 ** len(RULES)`` rows whatever
the corpus, and answers for all policies from that.

Rules are whole-number comparisons of measurements, so no rounding decides. All
texts of a chunk are measured together by numpy, where they lie: nothing is shuffled.

Defined cases: a null or empty text has no words, no lines, and fails ``few_words`` only; lines of white
space do not count as lines; rows of documents are kept apart even if they repeat an id, have
none, or are equal; other columns are ignored; an empty table gives an empty ledger, and
ablations that count 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.memory import freeing
from lakeweir.llm.words import M1, NOT_SPACE, Words, hash_words, mix, ngrams, split

WINDOW = 5
_BYTES = np.arange(256)
NOT_NEWLINE = _BYTES != 10
SYMBOL = np.isin(_BYTES, np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
WORD_CHAR = NOT_SPACE & (_BYTES & 0xC0 != 0x80)

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words",
)

# Bit ``k`` belongs to rule ``k``. A rule keeps its place for ever; new ones go to the end.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "capitals": "100 * n_upper > 50 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "long_words": "word_chars > 40 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named set of rules that a document must not fail."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
STRICT = Policy("strict-1", tuple(RULES))


def mask_of(rules: Iterable[str]) -> int:
    names = list(RULES)
    return reduce(int.__or__, (1 << names.index(rule) for rule in rules), 0)


def per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the marked bytes each text has."""
    return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[bounds])


def seen_twice(text: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the hashed things equal another, and which an earlier one, of the same text."""
    key = mix(h1 + (text.astype(np.uint64) + np.uint64(1)) * M1)
    order = np.argsort(key, kind="stable")
    same = (key[order][1:] == key[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    again = np.zeros(len(key), bool)
    again[order[1:]] = same
    several = again.copy()
    several[order[:-1]] |= same
    return several, again


def lines_of(w: Words, lines: Words) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that equal an earlier line, per text."""
    inside = np.concatenate([[0], np.cumsum(NOT_SPACE[w.raw], dtype=np.int64)])
    wordy = inside[lines.end] > inside[lines.start]
    text = lines.text_of_word()
    h1, h2 = hash_words(lines)
    _, again = seen_twice(text, h1, h2)
    n_lines = np.bincount(text[wordy], minlength=lines.texts)
    return n_lines, np.bincount(text[wordy & again], minlength=lines.texts)


def repeat_words_of(w: Words, window: int) -> np.ndarray:
    """Words of each text that lie in a window of words found twice or more in it."""
    h1, h2 = hash_words(w)
    text = w.text_of_word()
    at = np.flatnonzero(w.room() >= window)
    several, _ = seen_twice(text[at], ngrams(h1, window)[at], ngrams(h2, window)[at])
    at = at[several]
    depth = np.zeros(len(h1) + 1, np.int64)
    depth[at] += 1
    depth[at + window] -= 1
    return np.bincount(text[np.cumsum(depth)[:-1] > 0], minlength=w.texts)


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, text): ``id`` and ``MEASURES``."""
    for batch in batches:
        texts = batch.column(1)
        for w, lines in zip(split(texts, NOT_SPACE), split(texts, NOT_NEWLINE)):
            n_lines, n_dup_lines = lines_of(w, lines)
            columns = (
                np.diff(w.first),
                per_text(WORD_CHAR[w.raw], w.bounds),
                per_text(SYMBOL[w.raw], w.bounds),
                per_text(UPPER[w.raw], w.bounds),
                n_lines,
                n_dup_lines,
                repeat_words_of(w, WINDOW),
            )
            arrays = [pa.array(c.astype(np.int64)) for c in columns]
            ids = batch.column(0).slice(w.lo, w.texts)
            yield pa.RecordBatch.from_arrays([ids, *arrays], names=["id", *MEASURES])


def evaluate_rules(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The ledger: ``id``, ``MEASURES`` and ``bits``, one row per document."""
    kind = documents.schema[id_col].dataType.simpleString()
    ddl = ", ".join(f"{name} bigint" for name in MEASURES)
    measured = documents.select(id_col, text_col).mapInArrow(freeing(measure), f"id {kind}, {ddl}")
    failed = [
        F.when(F.expr(rule), F.lit(1 << k)).otherwise(0).cast("bigint")
        for k, rule in enumerate(RULES.values())
    ]
    return measured.withColumn("bits", reduce(Column.bitwiseOR, failed))


def passes(policy: Policy, bits: str = "bits") -> Column:
    """Whether a policy keeps a row of the ledger."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def ablations(ledger: DataFrame, policies: Iterable[Policy]) -> DataFrame:
    """What each rule of each policy does, from the bits of the ledger.

    ``version``, ``rule``, ``n_documents``, ``n_kept`` by the policy, ``n_failed`` the rule,
    ``n_failed_alone`` (no other rule of the policy), ``n_kept_without`` the rule.
    """
    cases = [
        F.struct(
            F.lit(p.version).alias("version"),
            F.lit(rule).alias("rule"),
            F.lit(p.mask).cast("bigint").alias("mask"),
            F.lit(mask_of([rule])).cast("bigint").alias("bit"),
        )
        for p in policies
        for rule in p.rules
    ]
    patterns = ledger.groupBy("bits").agg(F.count("*").alias("n"))
    # A row that counts nothing makes all cases appear for an empty ledger.
    zero = ledger.sparkSession.range(1).select(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    each = patterns.union(zero).select("bits", "n", F.inline(F.array(*cases)))
    fails = F.col("bits").bitwiseAND(F.col("mask"))

    def count(when: Column) -> Column:
        return F.sum(F.when(when, F.col("n")).otherwise(0))

    return each.groupBy("version", "rule").agg(
        F.sum("n").alias("n_documents"),
        count(fails == 0).alias("n_kept"),
        count(fails.bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(fails == F.col("bit")).alias("n_failed_alone"),
        count((fails == 0) | (fails == F.col("bit"))).alias("n_kept_without"),
    )
