"""Words, word hashes and n-gram hashes of many texts at once, in numpy.

Used inside ``mapInArrow``: Spark partitions the texts, and each task works
through its Arrow batches in chunks of a few megabytes, so the memory of a task
follows the chunk or the longest single text, whichever is larger.

Words are runs of bytes of a class. All classes used here treat the bytes of a
multi-byte UTF-8 character alike, so bytes can be used in place of characters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
LONG_WORD = 256
U = np.uint64
M1, M2, M3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
STEP = U(0xD6E8FEB86659FD93)

_BYTES = np.arange(256)
# Anything but ASCII white space.
NOT_SPACE = (_BYTES != 32) & ~((_BYTES >= 9) & (_BYTES <= 13))
# ASCII digits, ASCII lower-case letters and every byte of other characters.
ALNUM_LOWER = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)


@dataclass
class Words:
    """The words of a run of texts. Text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    lo: int  # index of the first text in its batch
    buf: np.ndarray  # bytes of all texts, as hashed
    raw: np.ndarray  # the same before lower-casing
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    bounds: np.ndarray  # where each text lies in the buffer

    @property
    def texts(self) -> int:
        return len(self.first) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), np.diff(self.first))

    def room(self) -> np.ndarray:
        """For each word, how many words its text has from there on."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.start))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    where = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(where):
        where = np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), where


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes; a longer text is a run by itself."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def split(
    texts: pa.Array, word: np.ndarray, lower: bool = False, limit: int = CHUNK_BYTES
) -> Iterator[Words]:
    """Words of a string array, a chunk at a time."""
    data, offsets = text_buffers(texts)
    for lo, hi in chunks(offsets, limit):
        raw = data[offsets[lo] : offsets[hi]]
        buf = np.zeros(len(raw) + 8, np.uint8)
        buf[:-8] = LOWER[raw] if lower else raw
        bounds = offsets[lo : hi + 1] - offsets[lo]
        inside = word[buf[:-8]]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = bounds[:-1]
        edges = edges[edges < len(inside)]
        begins[edges] = inside[edges]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = bounds[1:] - 1
        edges = edges[edges >= 0]
        ends[edges] = inside[edges]
        start = np.flatnonzero(begins)
        yield Words(
            lo, buf, raw, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds), bounds
        )


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, in place."""
    h ^= h >> U(30)
    h *= M2
    h ^= h >> U(27)
    h *= M3
    h ^= h >> U(31)
    return h


def hash_words(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    size = w.end - w.start
    h1 = size.astype(np.uint64) * M1
    h2 = size.astype(np.uint64) * STEP + M3
    if not len(size):
        return h1, h2
    lanes = np.ndarray((len(w.buf) - 7,), "<u8", w.buf, strides=(1,))
    todo, at, left = np.arange(len(size)), w.start, size
    if (size > LONG_WORD).any():
        for i in np.flatnonzero(size > LONG_WORD):
            digest = hashlib.blake2b(w.buf[w.start[i] : w.end[i]].tobytes(), digest_size=16)
            h1[i], h2[i] = np.frombuffer(digest.digest(), "<u8")
        todo = np.flatnonzero(size <= LONG_WORD)
        at, left = w.start[todo], size[todo]
    whole = len(todo) == len(size)
    while len(todo):
        lane = lanes[at] & _KEEP[np.minimum(left, 8)]
        if whole:
            h1 = mix((h1 ^ lane) * M1)
            h2 = mix((h2 + lane) * STEP)
            whole = False
        else:
            h1[todo] = mix((h1[todo] ^ lane) * M1)
            h2[todo] = mix((h2[todo] + lane) * STEP)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h1, h2


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last ``n - 1`` places mean nothing.

    Equal runs of words have equal hashes. Built by doubling: runs of 1, 2, 4, ...
    words are put together to the wanted length.
    """
    total, have, block, size = None, 0, h, 1
    while True:
        if n & size:
            if total is None:
                total, have = block, size
            else:
                total, have = _follow(total, block, have), have + size
        if size * 2 > n:
            return mix(total.copy())
        block = _follow(block, block, size)
        size *= 2


def _follow(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
    out = a * M1
    out ^= out >> U(29)
    out[: max(len(out) - gap, 0)] += b[gap:] * STEP
    out *= M2
    return out


def window_minima(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least hash among the ``width`` places from each place on, and its first place."""
    value, place = h, np.arange(len(h))
    out, where, have, size = None, None, 0, 1
    while True:
        if width & size:
            if out is None:
                out, where, have = value, place, size
            else:
                out, where = _least(out, where, value, place, have)
                have += size
        if size * 2 > width:
            return out, where
        value, place = _least(value, place, value, place, size)
        size *= 2


def _least(a, pa_, b, pb, gap):
    value, place = a.copy(), pa_.copy()
    n = max(len(a) - gap, 0)
    less = b[gap:] < a[:n]
    value[:n][less] = b[gap:][less]
    place[:n][less] = pb[gap:][less]
    return value, place


def signed(h: np.ndarray) -> np.ndarray:
    """Hashes as Spark's longs."""
    return h.view(np.int64)
