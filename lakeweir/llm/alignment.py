"""Alignment of two tokenizers by the spans of their tokens.

Tokenizer A is a byte-level ``tokenizers`` file, B a ``sentencepiece`` model. Both split the same string, a
space and the text. The spans they give with their tokens are coarse cuts: characters for A,
begin and end of each piece for B. They are exact wherever a token starts and ends between
characters. Tokens that share a character, and byte-fallback tokens, are refined by the number of bytes they
decode to. At last the decoded bytes of each side must be the string; if they are not (a
tokenizer that changes its input), the text has no tokens.

Neither tokenizer joins across a place where a space follows a character that is not white space:
A's pattern cuts there, and B has no piece that holds a space after something else (checked when it is loaded).
Such places are ends of tokens on both sides, so what lies between two of them, a segment, is aligned alone, and
a text's alignment is that of its segments. A bounded table of each Python worker remembers aligned segments, from task
to task; when it is full, those used more than once stay, the most frequent up to half of it.
New segments of a batch are put one after the other into runs, encoded together and aligned by numpy. A
run that does not come back byte by byte is halved until the segments at fault are alone.

Corpus-wide counts of linked id pairs: texts are encoded once, and what was found, with the pairs of each
text, is stored. Tasks add up the pairs they read, a shuffle adds up the tasks' sums, and a second
pass over the stored pairs looks the counts up. Counts of the ``TOP_PAIRS`` most frequent pairs are broadcast,
a fixed size. What is rarer is looked up by a join on the pair, in which no key can be frequent.

Defined cases: texts that are null, empty, or not reproduced by both tokenizers have no tokens and
count 0; rows are kept apart even if they repeat an id, have none, or are equal; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Encoding, Tokenizer

from lakeweir.llm.memory import freeing
from lakeweir.llm.storage import Workspace
from lakeweir.llm.tokens import byte_letters
from lakeweir.llm.words import chunks

TOP_PAIRS = 1 << 20
KNOWN_SEGMENTS = 200_000
RUN_LETTERS = 1_500
KNOWN_LETTERS = 8 << 20
SPACE_MARK = "▁"
CUT = re.compile(r"(?<=\S)(?= (?s:.))")  # a last space stays, as B has no pieces for an empty text
SHIFT = 32

SUMS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@dataclass(frozen=True)
class Aligned:
    """Segments one after the other: the first four of ``SUMS`` of each, group texts joined by ``;``, and id pairs
    of all links, as ``a << 32 | b``."""

    numbers: np.ndarray
    groups: list[str]
    pairs: np.ndarray


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of_letter = {letter: n for n, letter in enumerate(byte_letters())}
        self.bytes_a = {
            n: bytes(of_letter[c] for c in entry) if all(c in of_letter for c in entry) else None
            for entry, n in self.a.get_vocab(with_added_tokens=True).items()
        }
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(n) for n in range(size)]
        byte_b = {n for n in range(size) if self.b.is_byte(n)}
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if n in byte_b else p.replace(SPACE_MARK, " ").encode()
            for n, p in enumerate(pieces)
        ]
        self.sizes_a = np.array([len(self.bytes_a.get(n) or b"") for n in range(max(self.bytes_a) + 1)])
        self.sizes_b = np.array([len(raw) for raw in self.bytes_b])
        self.single_b = np.array([self.b.is_byte(n) for n in range(size)])
        # How an id is written within a group and at its side's end, by twice the id plus 1 at the end.
        self.written_a = written_ids(len(self.sizes_a), "|")
        self.written_b = written_ids(size, ";")
        control = [self.b.is_control(n) or self.b.is_unknown(n) for n in range(size)]
        self.cuts = not any(
            re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", p) for p, c in zip(pieces, control) if not c
        )

    def segments(self, text: str) -> list[str]:
        return CUT.split(text) if self.cuts else [text]

    def align(self, segments: list[str]) -> Iterator[tuple[list[int], Aligned]]:
        """Runs of segments, by their numbers, and their alignment; those whose bytes are not
        reproduced are left out.

        Each begins with a space, so those that do not end with white space may go on in a run.
        """
        runs, alone, letters = [[]], [], 0
        for k, segment in enumerate(segments):
            if not self.cuts or segment[-1].isspace():
                alone.append([k])
                continue
            if letters > RUN_LETTERS:
                runs.append([])
                letters = 0
            runs[-1].append(k)
            letters += len(segment)
        runs = [run for run in runs if run] + alone
        while runs:
            texts = ["".join([segments[k] for k in run]) for run in runs]
            found_a = self.a.encode_batch(texts, add_special_tokens=False)
            halves = []
            for run, text, a in zip(runs, texts, found_a):
                aligned = self.align_run(text, [len(segments[k]) for k in run], a)
                if aligned is not None:
                    yield run, aligned
                elif len(run) > 1:
                    halves += [run[: len(run) // 2], run[len(run) // 2 :]]
            runs = halves

    def align_run(self, text: str, letters: list[int], found_a: Encoding) -> Aligned | None:
        data = text.encode()
        found_b = self.b.encode(text[1:], return_type="offset_mapping")
        ids_a, ids_b = found_a.ids, found_b["ids"]
        raw_a = list(map(self.bytes_a.__getitem__, ids_a))
        if None in raw_a or b"".join(raw_a) != data:
            return None
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != data:
            return None
        # Bytes before each character.
        at = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
        at = np.append(at, len(data))
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        spans_a, spans_b = spans_of(found_a.offsets), spans_of(found_b["offsets"])
        ends_a = refine(spans_a, self.sizes_a[ids_a], at, np.zeros(len(ids_a), bool))
        # B does not see the space in front, so its characters are one behind.
        ends_b = refine(spans_b + 1, self.sizes_b[ids_b], at, self.single_b[ids_b])
        stops = at[np.cumsum(letters)]
        return self.joined(ids_a, ends_a, ids_b, ends_b, stops, len(data))

    def joined(
        self,
        ids_a: np.ndarray,
        ends_a: np.ndarray,
        ids_b: np.ndarray,
        ends_b: np.ndarray,
        stops: np.ndarray,
        size: int,
    ) -> Aligned | None:
        """Groups between common ends, and links between tokens that overlap, for segments up to ``stops``;
        None if a segment does not stop at a common end.

        Between two ends of either side lies one token of A and one of B, and no other place links them.
        """
        has_a, has_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        has_a[ends_a], has_b[ends_b] = True, True
        shared, either = has_a & has_b, has_a | has_b
        if not shared[size] or not shared[stops].all():
            return None
        # Ends of each kind up to and with each byte.
        before_a, before_b, groups, links = (np.cumsum(has) for has in (has_a, has_b, shared, either))
        ends = np.flatnonzero(either)
        pairs = ids_a[before_a[ends] - has_a[ends]] << SHIFT | ids_b[before_b[ends] - has_b[ends]]
        upto = np.stack([before_a[stops], before_b[stops], groups[stops], links[stops]], axis=1)
        last_a, last_b = shared[ends_a], shared[ends_b]
        written = np.concatenate([self.written_a[2 * ids_a + last_a], self.written_b[2 * ids_b + last_b]])
        # A group's tokens of A come before those of B.
        place = np.concatenate([2 * (groups[ends_a] - last_a), 2 * (groups[ends_b] - last_b) + 1])
        written = written[np.argsort(place, kind="stable")].tolist()
        to = (upto[:, 0] + upto[:, 1]).tolist()
        texts = ["".join(written[lo:hi])[:-1] for lo, hi in zip([0, *to], to)]
        return Aligned(np.diff(upto, axis=0, prepend=0), texts, pairs)


def written_ids(size: int, end: str) -> np.ndarray:
    return np.array([f"{n}{mark}" for n in range(size) for mark in (",", end)], object)


def spans_of(offsets: list[tuple[int, int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(offsets), np.int64, 2 * len(offsets)).reshape(-1, 2)


def refine(spans: np.ndarray, sizes: np.ndarray, at: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes.

    ``at`` gives the bytes before each character. A token that shares a character with the next
    one, or is a ``single`` byte, ends as many bytes on as the tokens so far decode to.
    """
    shares = np.append(spans[1:, 0] < spans[:-1, 1], False)
    return np.where(single | shares, np.cumsum(sizes), at[spans[:, 1]])


class Segments(dict):
    """Number of each known segment, or -1 if it has no tokens, and what is known of each number."""

    def __init__(self, aligner: Aligner):
        super().__init__()
        self.aligner = aligner
        self.numbers = np.zeros((0, 4), np.int64)
        self.uses = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.groups: list[str] = []
        self.letters = 0

    def renew(self) -> None:
        """Forget what is rarely used, and all that has no tokens."""
        names = [""] * len(self.groups)
        for segment, k in self.items():
            if k >= 0:
                names[k] = segment
        sizes = np.fromiter(map(len, names), np.int64, len(names))
        often = np.argsort(-self.uses, kind="stable")[: KNOWN_SEGMENTS // 2]
        kept = (self.uses[often] > 1) & (np.cumsum(sizes[often]) <= KNOWN_LETTERS // 2)
        often = np.sort(often[kept])
        self.pairs = self.pairs_of(often)
        # Older uses count less than those to come.
        self.numbers, self.uses = self.numbers[often], self.uses[often] // 2
        self.groups = [self.groups[k] for k in often]
        self.letters = int(sizes[often].sum())
        self.clear()
        self.update((names[k], n) for n, k in enumerate(often))

    def learn(self, segments: Iterable[str]) -> None:
        new = list(dict.fromkeys(filterfalse(self.__contains__, segments)))
        found = dict.fromkeys(new, -1)
        numbers, pairs, groups = [self.numbers], [self.pairs], list(self.groups)
        for run, aligned in self.aligner.align(new):
            found.update(zip([new[k] for k in run], range(len(groups), len(groups) + len(run))))
            groups += aligned.groups
            numbers.append(aligned.numbers)
            pairs.append(aligned.pairs)
        self.numbers, self.pairs, self.groups = np.concatenate(numbers), np.concatenate(pairs), groups
        self.uses = np.append(self.uses, np.zeros(len(groups) - len(self.uses), np.int64))
        self.letters += sum(map(len, new))
        self.update(found)

    @property
    def full(self) -> bool:
        return len(self) > KNOWN_SEGMENTS or self.letters > KNOWN_LETTERS

    def of(self, texts: list[str | None]) -> list[list[int]]:
        """Segments of each text, none if it has no tokens."""
        split = [self.aligner.segments(" " + text) if text else [] for text in texts]
        self.learn(chain.from_iterable(split))
        numbers = [list(map(self.__getitem__, segments)) for segments in split]
        return [[] if -1 in own else own for own in numbers]

    def used(self, numbers: np.ndarray) -> None:
        self.uses += np.bincount(numbers, minlength=len(self.uses))

    def pairs_of(self, numbers: np.ndarray) -> np.ndarray:
        """Pairs of segments one after the other."""
        sizes = self.numbers[:, 3]
        begin = (np.cumsum(sizes) - sizes)[numbers]
        size = sizes[numbers]
        first = np.repeat(begin - (np.cumsum(size) - size), size)
        return self.pairs[first + np.arange(len(first))]


def some_texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of batches of about ``CHUNK_BYTES`` of a column of texts or bytes, with its values."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in chunks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])):
            part = batch.slice(lo, hi - lo)
            yield part, part.column(column).to_pylist()


_SEGMENTS: dict[tuple[str, str], Segments] = {}


def known_segments(path_a: str, path_b: str) -> Segments:
    """One table per pair of files and Python worker. It only saves work: what a segment aligns to is fixed."""
    if (path_a, path_b) not in _SEGMENTS:
        _SEGMENTS[path_a, path_b] = Segments(Aligner(path_a, path_b))
    return _SEGMENTS[path_a, path_b]


def aligned_rows(path_a: str, path_b: str, keep_groups: bool) -> Callable:
    """From (id, text): numbers of tokens, groups and links, the groups' digest, and pairs as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_segments(path_a, path_b)
        for batch, texts in some_texts(batches, 1):
            each = known.of(texts)
            ends = np.cumsum([0, *map(len, each)])
            own = np.fromiter(chain.from_iterable(each), np.int64, ends[-1])
            known.used(own)
            upto = np.zeros((len(own) + 1, 4), np.int64)
            np.cumsum(known.numbers[own], axis=0, out=upto[1:])
            sums = np.diff(upto[ends], axis=0)
            pairs = known.pairs_of(own)
            to = np.cumsum(sums[:, 3]).tolist()
            written = [";".join(map(known.groups.__getitem__, numbers)) for numbers in each]
            digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
            arrays = [batch.column(0), *(pa.array(c) for c in sums.T), pa.array(digests)]
            arrays.append(pa.array([pairs[lo:hi].tobytes() for lo, hi in zip([0, *to], to)], pa.binary()))
            names = ["id", *SUMS[:4], "groups_sha256", "pairs"]
            if keep_groups:
                arrays.append(pa.array(written))
                names.append("groups")
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            if known.full:
                known.renew()

    return freeing(run)


def pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pairs as bytes: each pair and its number of links in some texts."""
    for batch in batches:
        for _, texts in some_texts([batch], 0):
            pairs, n = np.unique(np.frombuffer(b"".join(texts), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])


@dataclass(frozen=True)
class Counts:
    """Counts of the most frequent pairs, sorted by pair, and the highest count of each id of B."""

    pairs: np.ndarray
    n: np.ndarray
    best: np.ndarray

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair, or 0 if it is not among the frequent ones."""
        if not len(self.pairs):
            return np.zeros(len(pairs), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.n[at], 0)


def counted_rows(counts: Broadcast) -> Callable:
    """From (pairs as bytes, others): the others, links with the highest count, sum of counts, and
    pairs whose count is not known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent: Counts = counts.value
        for batch, texts in some_texts(batches, 0):
            sizes = [len(text) // 8 for text in texts]
            pairs = np.frombuffer(b"".join(texts), np.int64)
            text = np.repeat(np.arange(len(texts)), sizes)
            n = frequent.of(pairs)
            best = (n > 0) & (n == frequent.best[pairs & ((1 << SHIFT) - 1)])
            total = np.zeros(len(texts), np.int64)
            np.add.at(total, text, n)
            rare = np.flatnonzero(n == 0)
            bounds = np.searchsorted(rare, np.cumsum([0, *sizes])).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(bounds), pa.array(pairs[rare]))
            more = [pa.array(np.bincount(text[best], minlength=len(texts))), pa.array(total), rest]
            names = [*batch.schema.names[1:], "n_best", "count_sum", "rest"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *more], names=names)

    return freeing(run)


def align_tokens(
    documents: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    top_pairs: int = TOP_PAIRS,
    keep_groups: bool = False,
) -> DataFrame:
    """Per document: ``id``, ``n_a``, ``n_b`` tokens, ``n_groups`` between common ends, ``n_links`` of
    tokens that overlap, ``n_best`` of them whose pair is the most frequent of its B id, ``count_sum``
    of their pairs' counts, ``groups_sha256``; with ``keep_groups`` also the ``groups`` as text.
    """
    spark = documents.sparkSession
    work = Workspace(spark, "alignment")
    kind = documents.schema[id_col].dataType.simpleString()
    ddl = f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
    own = ", groups string" if keep_groups else ""
    aligned = documents.select(id_col, text_col).mapInArrow(
        aligned_rows(path_a, path_b, keep_groups), f"{ddl}, pairs binary{own}"
    )
    aligned = work.store(aligned, "aligned")
    pairs = aligned.select("pairs").mapInArrow(freeing(pair_rows), "pair bigint, n bigint")
    pairs = work.store(pairs.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    total, frequent = pairs.count(), pairs
    if total > top_pairs:
        share = F.percentile_approx("n", 1 - top_pairs / total, 10_000)
        frequent = pairs.filter(F.col("n") > pairs.agg(share.alias("n")).collect()[0]["n"])
    table = frequent.orderBy("pair").toArrow()
    id_b = F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))
    # One row per id of B at most, as many as its vocabulary has.
    highest = pairs.groupBy(id_b.alias("b")).agg(F.max("n").alias("best"))
    best = np.zeros(1, np.int64)
    rows = highest.toArrow()
    if rows.num_rows:
        best = np.zeros(int(rows["b"].to_numpy().max()) + 1, np.int64)
        best[rows["b"].to_numpy()] = rows["best"].to_numpy()
    counts = spark.sparkContext.broadcast(Counts(table["pair"].to_numpy(), table["n"].to_numpy(), best))

    aligned = aligned.select("pairs", *[c for c in aligned.columns if c != "pairs"]).mapInArrow(
        counted_rows(counts), f"{ddl}{own}, n_best bigint, count_sum bigint, rest array<bigint>"
    )
    aligned = aligned.select("id", *SUMS, "groups_sha256", "rest", *(["groups"] if keep_groups else []))
    if frequent is pairs:
        return aligned.drop("rest")
    aligned = work.store(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    rest = aligned.select("row", F.explode("rest").alias("pair")).groupBy("row", "pair")
    rest = rest.agg(F.count("*").alias("links")).join(pairs.hint("merge"), "pair")
    rest = rest.withColumn("b", id_b).join(F.broadcast(highest), "b")
    more = rest.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
        F.sum(F.col("links") * F.col("n")).alias("more_sum"),
    )
    none = F.lit(0).cast("bigint")
    return (
        aligned.join(more, "row", "left")
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", none))
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", none))
        .drop("row", "rest", "more_best", "more_sum")
    )
