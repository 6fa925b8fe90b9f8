"""Token ids of many texts at once.

Where a tokenizer drops white space, the ids of a text are those of its words one
after the other, so each distinct word of a chunk is encoded once. Words seen
before by the same Python worker come from a bounded table. Other tokenizers
encode whole texts.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from tokenizers import Tokenizer

from lakeweir.llm.words import NOT_SPACE, Words, hash_words, split, text_buffers

KNOWN_WORDS = 200_000
KNOWN_PIECES = 300_000
CHUNK_BYTES = 8 << 20

# Fixed values of the public vocabulary file whose words can be encoded one by one.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PIECE_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Words of printable ASCII and composed Latin letters: normalization leaves them alone,
# and letters, digits and the rest are told apart without Unicode tables. U+023A and U+023E
# are left out, as their lower case lies outside of these letters.
LETTER = "a-zA-ZÀ-ÖØ-öø-\u0239\u023b-\u023d\u023f-ɏ"
PLAIN = re.compile(f"[!-~{LETTER}]+")
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[0-9]|[^0-9{LETTER}]+")


def byte_letters() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in own}
    rest = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + n) for n, b in enumerate(rest)})
    return [letters[b] for b in range(256)]


class WordEncoder:
    """Encodes texts with one tokenizer file, appending ``end_id`` to each if it is given."""

    def __init__(self, path: str, end_id: int | None):
        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        most = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
        self.dtype = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        steps = (parts.get("normalizer") or {}).get("normalizers")
        splits = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            steps == NORMALIZERS
            and splits[0].get("pattern") == {"Regex": PIECE_PATTERN}
            and [s.get("type") for s in splits] == ["Split", "ByteLevel"]
        )
        added = [re.escape(t["content"]) for t in parts.get("added_tokens", [])]
        self.added = re.compile("|".join(added) or "(?!)")
        self.letters = byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def word(self, raw: bytes) -> bytes:
        """Ids of one word."""
        text = raw.decode("utf-8", "replace")
        if not PLAIN.fullmatch(text) or self.added.search(text):
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        text = text.lower()
        pieces = self.pieces
        whole = pieces.get(text)  # a piece is not split any further
        if whole is not None:
            return whole
        out = []
        for piece in PIECE.findall(text):
            ids = pieces.get(piece)
            if ids is None:
                if len(pieces) >= KNOWN_PIECES:
                    pieces.clear()
                # Printable ASCII is written as it is.
                written = piece if piece.isascii() else "".join(
                    [self.letters[b] for b in piece.encode()]
                )
                ids = self.packed([t.id for t in self.tokenizer.model.tokenize(written)])
                pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per chunk: its first text, all ids, and the bounds of each text among them."""
        if self.by_word:
            for w in split(texts, NOT_SPACE, limit=CHUNK_BYTES):
                yield w.lo, *self._words(w)
            return
        data, offsets = text_buffers(texts)
        for lo in range(len(offsets) - 1):
            text = data[offsets[lo] : offsets[lo + 1]].tobytes().decode("utf-8", "replace")
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            if self.end_id is not None:
                ids.append(self.end_id)
            yield lo, np.array(ids, self.dtype), np.array([0, len(ids)])

    def distinct(self, w: Words) -> tuple[np.ndarray, list[bytes]]:
        """Which of the distinct words each word is, and their packed ids."""
        h1, h2 = hash_words(w)
        codes, distinct = pd.factorize(h1)
        first = np.zeros(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        if not np.array_equal(h2[first[codes]], h2):  # two words with one hash
            codes, first = np.arange(len(h1)), np.arange(len(h1))
        data, known, ids = w.raw.tobytes(), self.words, []
        for start, end in zip(w.start[first].tolist(), w.end[first].tolist()):
            raw = data[start:end]
            got = known.get(raw)
            if got is None:
                got = self.word(raw)
                if len(raw) <= 64:
                    if len(known) >= KNOWN_WORDS:
                        known.clear()
                    known[raw] = got
            ids.append(got)
        return codes, ids

    def word_sizes(self, w: Words) -> np.ndarray:
        """Number of ids of each word."""
        codes, ids = self.distinct(w)
        size = np.array([len(i) for i in ids], np.int64) // self.dtype.itemsize
        return size[codes]

    def _words(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        codes, ids = self.distinct(w)
        bounds = w.first
        if self.end_id is not None:
            ids.append(self.packed([self.end_id]))
            codes = np.insert(codes, w.first[1:], len(ids) - 1)
            bounds = w.first + np.arange(len(w.first))
        flat = np.frombuffer(b"".join(ids), self.dtype)
        size = np.array([len(i) for i in ids], np.int64) // self.dtype.itemsize
        begin = np.cumsum(size) - size
        each = size[codes]
        stop = np.cumsum(each)
        where = np.repeat(begin[codes] - (stop - each), each)
        where += np.arange(len(where))
        return flat[where], np.concatenate([[0], stop])[bounds]


_ENCODERS: dict[tuple[str, int | None], WordEncoder] = {}


def encoder(path: str, end_id: int | None = None) -> WordEncoder:
    """One encoder per file and Python worker."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = WordEncoder(path, end_id)
    return _ENCODERS[path, end_id]
