"""Roles of transcript lines by a hidden Markov model, and canonical turns.

A state is a role and whether the line begins a turn. A line is observed by its speaker marker
("User:", "### Assistant", "[SYSTEM]", "<bot>", "Q:" or none), by whether a blank line precedes
it, by its length and by whether it asks. The most likely states are found by Viterbi.

Transcripts come as pieces in order of ``seq``: one for a whole transcript, or many. They are
dealt by ranges of (id, seq), so a transcript with a third of all pieces lies in many
parts of bounded size:

1. For the first and the last transcript of a part, which may go on in other parts, the best score
   from each state before to each state at the end is computed, a small matrix.
2. Matrices of a transcript are put together in order of parts, which gives the states at the
   borders of parts. Only borders meet in this step, two rows per part.
3. Each part finds its states between the border states and renders its pieces.

Rendered pieces of a transcript, put one after the other, are the canonical transcript: turns
as ``<|role|>``, a line break, the text and ``<|end|>``.

Defined cases: a null or empty text is a piece without lines and renders as nothing, but for the
last end mark; a null role or unknown role in training data is left out; equal pieces are parsed
once, and each row of them gets the result; pieces that share id and seq are ordered by text; a null id is a transcript like any other, a
null seq comes first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.storage import Workspace

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role + len(ROLES) * inside
PART_ROWS = 20_000
# Copies of a piece that one task writes out.
COPIES = 10_000
NEVER = -1e9

# Names that speakers go by in transcripts, fixed values.
NAMES = {
    "system": ("system", "instruction", "instructions", "context", "sys"),
    "user": ("user", "human", "question", "q", "customer", "prompter", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model", "response", "agent"),
}
ROLE_OF = {name: k for k, role in enumerate(ROLES) for name in NAMES[role]}
MARKER = re.compile(
    r"\s*(?:#+\s*(?P<h>[A-Za-z]+)\s*:?|\[(?P<b>[A-Za-z]+)\]\s*:?|<\|?(?P<t>[A-Za-z]+)\|?>\s*:?"
    r"|\*\*(?P<s>[A-Za-z]+):?\*\*:?|(?P<c>[A-Za-z]{1,14})\s*:)(?:\s+|$)"
)
NO_MARKER = len(ROLES)
SYMBOLS = (len(ROLES) + 1) * 2 * 4 * 2


def observe(text: str) -> tuple[list[int], list[str]]:
    """Symbols of the lines of a piece, and their text without markers; blank lines are left out."""
    symbols, lines, blank = [], [], False
    for line in text.split("\n"):
        if not line.strip():
            blank = True
            continue
        found = MARKER.match(line)
        name = next((g for g in found.groups() if g), "").lower() if found else ""
        marker = ROLE_OF.get(name, NO_MARKER)
        if marker != NO_MARKER:
            line = line[found.end() :]
        size = len(line)
        width = (size > 0) + (size > 120) + (size > 400)
        asks = line.rstrip().endswith("?")
        symbols.append(((marker * 2 + blank) * 4 + width) * 2 + asks)
        lines.append(line)
        blank = False
    return symbols, lines


@dataclass
class Model:
    """Log scores: first state, next state (from, to) and symbol (state, symbol)."""

    first: np.ndarray
    follow: np.ndarray
    symbol: np.ndarray

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Model:
        """Counts of (kind, row, column), smoothed by a small constant."""
        first, follow, symbol = (counts[k] for k in range(3))
        first, follow = first[0, :STATES] + 0.1, follow[:STATES, :STATES] + 0.01
        # A turn goes on only as the role it began with.
        for s in range(STATES):
            for t in range(len(ROLES), STATES):
                if t - len(ROLES) != s % len(ROLES):
                    follow[s, t] = 0
        first[len(ROLES) :] = 0
        symbol = symbol[:STATES, :SYMBOLS] + 0.05
        with np.errstate(divide="ignore"):
            return cls(
                np.maximum(np.log(first / first.sum()), NEVER),
                np.maximum(np.log(follow / follow.sum(axis=1, keepdims=True)), NEVER),
                np.log(symbol / symbol.sum(axis=1, keepdims=True)),
            )

    def span(self, symbols: list[int]) -> np.ndarray:
        """Best score from each state before the lines (last row: none) to each at their end."""
        best = np.full((STATES + 1, STATES + 1), NEVER)
        np.fill_diagonal(best, 0.0)
        for symbol in symbols:
            step = (best[:, :STATES, None] + self.follow[None]).max(axis=1)
            start = best[:, STATES, None] + self.first[None]
            best[:, :STATES] = np.maximum(step, start) + self.symbol[:, symbol]
            best[:, STATES] = NEVER
        return best

    def path(self, symbols: list[int], before: int, after: int | None) -> list[int]:
        """Best states of the lines, from the state before (``STATES``: none) to that at the end."""
        if not symbols:
            return []
        came = np.zeros((len(symbols), STATES), np.int64)
        score = (self.first if before == STATES else self.follow[before]) + self.symbol[:, symbols[0]]
        for i, symbol in enumerate(symbols[1:], 1):
            step = score[:, None] + self.follow
            came[i] = step.argmax(axis=0)
            score = step.max(axis=0) + self.symbol[:, symbol]
        states = [int(score.argmax()) if after is None or after == STATES else after]
        for i in range(len(symbols) - 1, 0, -1):
            states.append(int(came[i, states[-1]]))
        return states[::-1]


def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (first, role, text) of marked pieces: counts of (kind, row, column)."""
    counts = np.zeros((3, STATES, SYMBOLS), np.int64)
    for batch in batches:
        for before, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if role not in ROLES:
                continue
            state = ROLES.index(role)
            last = None if before is None else ROLES.index(before) if before in ROLES else None
            symbols, _ = observe(text or "")
            for i, symbol in enumerate(symbols):
                now = state if i == 0 else state + len(ROLES)
                counts[2, now, symbol] += 1
                if i:
                    counts[1, state if i == 1 else now, now] += 1
                elif last is None:
                    counts[0, 0, now] += 1
                else:
                    # The turn before may have ended on its first line or a later one.
                    counts[1, [last, last + len(ROLES)], now] += 1
    at = np.argwhere(counts)
    yield pa.RecordBatch.from_arrays(
        [*(pa.array(at[:, k]) for k in range(3)), pa.array(counts[tuple(at.T)])],
        names=["kind", "row", "column", "n"],
    )


def train(turns: DataFrame) -> Model:
    """Count states and symbols of marked-up turns: (before: role of the turn before or null,
    role, text). Tasks return tables of fixed size, which are added up."""
    rows = (
        turns.select("before", "role", "text")
        .mapInArrow(count_rows, "kind bigint, row bigint, column bigint, n bigint")
        .groupBy("kind", "row", "column")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros((3, STATES, SYMBOLS))
    for r in rows.collect():
        counts[r["kind"], r["row"], r["column"]] = r["n"]
    return Model.from_counts(counts)


def runs_of(ids: list) -> list[tuple[int, int]]:
    """Pieces of one transcript in a sorted part, as (first, behind the last)."""
    cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
    return list(zip(cuts[:-1], cuts[1:]))


def sorted_part(table: pa.Table) -> pa.Table:
    return table.take(pa.array(np.argsort(table.column("rank").to_numpy(), kind="stable")))


def border_rows(model: Model) -> Callable:
    """For the first and the last transcript of a part, the matrix of its lines."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = sorted_part(table)
        ids, texts = table.column("id").to_pylist(), table.column("text").to_pylist()
        runs = runs_of(ids)
        ends = runs if len(runs) < 2 else [runs[0], runs[-1]]
        spans = []
        for lo, hi in ends:
            symbols = [s for text in texts[lo:hi] for s in observe(text or "")[0]]
            spans.append(model.span(symbols).astype("<f8").tobytes())
        return pa.table(
            {
                "part": pa.array([key[0].as_py()] * len(ends), pa.int64()),
                "place": pa.array(range(len(ends)), pa.int64()),
                "id": pa.array([ids[lo] for lo, _ in ends], table.schema.field("id").type),
                "span": pa.array(spans, pa.binary()),
            }
        )

    return run


def join_borders(key: tuple, table: pa.Table) -> pa.Table:
    """States before and at the end of each part of one transcript."""
    rows = sorted(
        zip(*(table.column(c).to_pylist() for c in ("part", "place", "span"))), key=lambda r: r[:2]
    )
    spans = [np.frombuffer(s, "<f8").reshape(STATES + 1, STATES + 1) for _, _, s in rows]
    score = np.full(STATES + 1, NEVER)
    score[STATES] = 0.0
    came = []
    for span in spans:
        step = score[:, None] + span
        came.append(step.argmax(axis=0))
        score = step.max(axis=0)
    states = [int(score.argmax())]
    for back in came[::-1]:
        states.append(int(back[states[-1]]))
    states = states[::-1]
    return pa.table(
        {
            "part": [r[0] for r in rows],
            "place": [r[1] for r in rows],
            "before": pa.array(states[:-1], pa.int64()),
            "after": pa.array(states[1:], pa.int64()),
            "final": [i == len(rows) - 1 for i in range(len(rows))],
        }
    )


def part_rows(model: Model) -> Callable:
    """Roles and rendered text of the pieces of a part, given the states at its borders."""

    def run(key: tuple, table: pa.Table, borders: pa.Table) -> pa.Table:
        table = sorted_part(table)
        ids, texts = table.column("id").to_pylist(), table.column("text").to_pylist()
        known = {r["place"]: r for r in borders.to_pylist()}
        runs = runs_of(ids)
        roles, rendered = [], []
        for k, (lo, hi) in enumerate(runs):
            border = known.get(0 if k == 0 else 1) if k in (0, len(runs) - 1) else None
            before, after = (border["before"], border["after"]) if border else (STATES, None)
            pieces = [observe(text or "") for text in texts[lo:hi]]
            states = iter(model.path([s for p in pieces for s in p[0]], before, after))
            started = before != STATES
            for i, (_, lines) in enumerate(pieces):
                own, out = [], []
                for line in lines:
                    state = next(states)
                    role = ROLES[state % len(ROLES)]
                    if state < len(ROLES) or not started:
                        out.append(f"<|end|>\n<|{role}|>\n" if started else f"<|{role}|>\n")
                        own.append(role)
                        out.append(line)
                    else:
                        out.append("\n" + line)
                        own = own or [role]
                    started = True
                if started and lo + i == hi - 1 and (border is None or border["final"]):
                    out.append("<|end|>\n")
                roles.append(own)
                rendered.append("".join(out))
        return pa.table(
            {
                "id": table.column("id"),
                "seq": table.column("seq"),
                "copies": table.column("copies"),
                "roles": pa.array(roles, pa.list_(pa.string())),
                "rendered": pa.array(rendered, pa.string()),
            }
        )

    return run


def parse_transcripts(
    pieces: DataFrame,
    model: Model,
    id_col: str = "id",
    seq_col: str = "seq",
    text_col: str = "text",
    part_rows_limit: int = PART_ROWS,
) -> DataFrame:
    """Per piece: ``id``, ``seq``, ``roles`` of the turns it holds a line of, and ``rendered``."""
    work = Workspace(pieces.sparkSession, "transcripts")
    rows = pieces.groupBy(
        F.col(id_col).alias("id"), F.col(seq_col).alias("seq"), F.col(text_col).alias("text")
    ).agg(F.count("*").alias("copies"))
    rows = work.store(rows, "pieces")
    size = rows.agg(F.count("*").alias("n"), F.max("copies").alias("most")).collect()[0]
    parts = max(1, -(-size["n"] // part_rows_limit))
    order = ["id", "seq", F.xxhash64("text")]
    dealt = (
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id().cast("bigint"))
        .withColumn("rank", F.monotonically_increasing_id())
    )
    dealt = work.store(dealt, "parts")
    work.drop(rows)
    kind, place = (pieces.schema[c].dataType.simpleString() for c in (id_col, seq_col))
    borders = dealt.groupBy("part").applyInArrow(
        border_rows(model), f"part bigint, place bigint, id {kind}, span binary"
    )
    states = borders.groupBy("id").applyInArrow(
        join_borders, "part bigint, place bigint, before bigint, after bigint, final boolean"
    )
    parsed = (
        dealt.groupBy("part")
        .cogroup(states.groupBy("part"))
        .applyInArrow(
            part_rows(model),
            f"id {kind}, seq {place}, copies bigint, roles array<string>, rendered string",
        )
    )
    return each_copy(parsed, size["most"] or 1).select("id", "seq", "roles", "rendered")


def each_copy(parsed: DataFrame, most: int) -> DataFrame:
    """As many rows of each piece as it has copies; many copies are dealt over tasks."""
    one = F.lit(1).cast("bigint")
    if most > COPIES:
        share = F.explode(F.sequence(one * 0, F.call_function("div", F.col("copies") - 1, F.lit(COPIES))))
        parsed = parsed.withColumn("share", share).repartition("id", "seq", "share")
        left = F.least(F.col("copies") - F.col("share") * COPIES, F.lit(COPIES).cast("bigint"))
        parsed = parsed.withColumn("copies", left)
    return parsed.withColumn("copy", F.explode(F.sequence(one, F.col("copies"))))
