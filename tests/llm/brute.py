"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from functools import cache

import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@cache
def tokenizer() -> Tokenizer:
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text: str | None) -> list[int]:
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def shingles(text: str | None) -> set:
    words = WORD.findall(lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components(nodes: list, linked) -> dict:
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def near_duplicates(texts: dict) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both and 100 * both >= 80 * len(sets[a] | sets[b])

    return components(sorted(sets), linked)


def kept_words(texts: dict) -> dict:
    """Words left, by document, after removing what starts earlier."""
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    seen, gone = set(), {i: set() for i in words}
    for i in sorted(words):
        for at in range(len(words[i]) - 19):
            run = tuple(words[i][at : at + 20])
            if run in seen:
                gone[i].update(range(at, at + 20))
            seen.add(run)
    return {i: [w for k, w in enumerate(ws) if k not in gone[i]] for i, ws in words.items()}


def benchmark_hits(text: str | None, items: dict) -> tuple[int, set, set]:
    """Number of words, words hit and items found."""
    words = ALNUM.findall(lower(text))
    hit, found = set(), set()
    for item, item_text in items.items():
        own = ALNUM.findall(lower(item_text))
        size = min(10, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for at in range(len(words) - size + 1):
            if size and tuple(words[at : at + size]) in runs:
                found.add(item)
                hit.update(range(at, at + size))
    return len(words), hit, found
