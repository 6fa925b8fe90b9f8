"""Tokenizer alignment, conversation trie and rule ledger against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeweir.llm.alignment import align_tokens
from lakeweir.llm.list_ranking import list_places
from lakeweir.llm.prefix_trie import placed_turns, prefix_trie
from lakeweir.llm.quality_rules import BASE, MEASURES, RULES, STRICT, Policy, ablations, evaluate_rules, passes
from lakeweir.llm.queries import read
from lakeweir.llm.scans import scanned
from lakeweir.llm.storage import Workspace
from lakeweir.llm.tokens import byte_letters
from tests.llm import brute
from tests.llm.test_edges import documents, nothing, texts  # noqa: F401

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")


class Both:
    """Whole texts by both tokenizers, byte ranges from decoded tokens alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATH_A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
        self.letters = {c: n for n, c in enumerate(byte_letters())}

    def tokens(self, text):
        """Two lists of (id, begin, end), or none."""
        if not text:
            return [], []
        data = (" " + text).encode()
        raw_a = [(t, bytes(self.letters.get(c, 0) for c in self.a.id_to_token(t)))
                 for t in self.a.encode(" " + text, add_special_tokens=False).ids]
        raw_b = []
        for t in self.b.encode(text):
            piece = self.b.id_to_piece(t)
            whole = bytes([int(piece[3:-1], 16)]) if self.b.is_byte(t) else piece.replace("▁", " ").encode()
            raw_b.append((t, whole))
        if b"".join(r for _, r in raw_a) != data or b"".join(r for _, r in raw_b) != data:
            return [], []
        out = []
        for raw in (raw_a, raw_b):
            end, spans = 0, []
            for t, r in raw:
                spans.append((t, end, end + len(r)))
                end += len(r)
            out.append(spans)
        return out[0], out[1]


def aligned_by_hand(rows):
    both = Both()
    counts, each = Counter(), []
    for _, text in rows:
        a, b = both.tokens(text)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        links, lo = [], 0
        for t, s, e in a:
            while lo < len(b) and b[lo][2] <= s:
                lo += 1
            k = lo
            while k < len(b) and b[k][1] < e:
                links.append((t, b[k][0]))
                k += 1
        groups, i, j = [], 0, 0
        for end in ends:
            own_a, own_b = [], []
            while i < len(a) and a[i][2] <= end:
                own_a.append(str(a[i][0]))
                i += 1
            while j < len(b) and b[j][2] <= end:
                own_b.append(str(b[j][0]))
                j += 1
            groups.append(f"{','.join(own_a)}|{','.join(own_b)}")
        counts.update(links)
        each.append((len(a), len(b), ";".join(groups), links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, each):
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        n_best = sum(counts[link] == best[link[1]] for link in links)
        n_groups = groups.count("|") if n_a else 0
        out.append((i, n_a, n_b, n_groups, len(links), n_best, sum(counts[k] for k in links), digest))
    return Counter(out)


ODD = [
    "<s>a</s> <unk> <0x41> <|endoftext|>", "é 日本語 🙂🙂 ẞ", "tab\there  two  spaces   ", " lead", "▁mark ▁",
    "é composed", "line\nbreak\r\n\r\nmore", "\x00\x01", "ﬁ ligature", "trailing ", " ", "\n", "ÿ" * 50, "a" * 300,
]


@pytest.mark.parametrize("top_pairs", [1 << 20, 40, 1])
def test_alignment(spark, documents, nothing, top_pairs):  # noqa: F811
    rows = [(i, t) for i, t, *_ in texts()] + [(500 + i, t) for i, t in enumerate(ODD)]
    extra = spark.createDataFrame([(i, t) for i, t in rows[len(texts()):]], "doc_id bigint, text string")
    frame = documents.select("doc_id", "text").union(extra)
    found = align_tokens(frame, PATH_A, PATH_B, top_pairs=top_pairs)
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r) for r in found.select(*names).collect()) == aligned_by_hand(rows)
    assert align_tokens(nothing, PATH_A, PATH_B).count() == 0


def test_alignment_of_the_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = align_tokens(docs, PATH_A, PATH_B, top_pairs=2000, keep_groups=True).collect()
    assert Counter((r.id, *r[1:8]) for r in found) == aligned_by_hand(rows)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in found if r.n_a)


def trie_by_hand(turns):
    """Rows of (conv, turn, role, text) as nodes."""
    order = sorted(
        (r for r in turns if r[0] is not None),
        key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""),
    )
    convs = defaultdict(list)
    for c, _, role, text in order:
        convs[c].append((role or "", text or ""))
    members = defaultdict(list)
    for c, own in convs.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].append(c)
    rows = []
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(brute.WORD.findall(n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(inside) if tuple(convs[c]) == node)
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(inside), len(node), parent, len(inside), len(children), len(leaves), saved,
                     hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(rows)


@pytest.mark.parametrize("nodes_per_task", [200_000, 15])
def test_trie(spark, nodes_per_task):
    rng = random.Random(4)
    turns = []
    for c in range(60):
        for k in range(rng.choice([1, 2, 3, 6, 9])):
            text = rng.choice(["same words here", "same words here", "other", None, "", "a b  c\n"])
            turns.append((c * 7, k if rng.random() < 0.9 else None, rng.choice(["user", "user", None]), text))
    turns += [(1, 0, "user", "x y"), (1, 0, "user", "x y"), (2, 0, "user", "x y"), (None, 0, "user", "lost")]
    turns += [(3, 0, "us", "er x"), (4, 0, "user", " x"), (5, 1, "user", "long " * 50), (6, 1, "user", "long " * 50 + "er")]
    schema = "conv_id bigint, turn int, role string, text string"
    frame = spark.createDataFrame(turns, schema).withColumn("depth", F.lit("clash")).repartition(3)

    def trie(table):
        work = Workspace(spark, "test")
        placed = placed_turns(table, work)
        ids = placed.filter("place = 0").select("conv")
        return prefix_trie(placed, ids, work, nodes_per_task)

    assert Counter(tuple(r) for r in trie(frame).collect()) == trie_by_hand(turns)
    assert trie(frame.limit(0)).count() == 0


@pytest.mark.parametrize("shuffled", [False, True])
def test_places_in_a_list(spark, shuffled):
    n = 400
    numbers = list(range(n))
    if shuffled:
        random.Random(5).shuffle(numbers)
    rows = [(x, numbers[k - 1] if k else None, 1 if k else 0) for k, x in enumerate(numbers)]
    links = spark.createDataFrame(rows, "node bigint, before bigint, steps bigint").repartition(4)
    found = list_places(links, Workspace(spark, "test"), 60).collect()
    assert sorted((r.place, r.node) for r in found) == list(enumerate(numbers))


def test_running_values(spark):
    """A group that covers several tasks, groups of one row, and ties."""
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, 3 + rng.randrange(40)]), rng.randrange(50), rng.randrange(100)) for _ in range(900)]
    frame = spark.createDataFrame(rows, "g bigint, o bigint, v bigint").repartition(5)
    found = scanned(frame, Workspace(spark, "test"), ["g"], ["o"], sums=["v"], xors=["v"], lags=["v"])
    got = sorted(found.collect(), key=lambda r: r["index"])
    assert [r["index"] for r in got] == list(range(len(rows)))
    assert [(r.g, r.o) for r in got] == sorted((g, o) for g, o, _ in rows)
    last = None
    for r in got:
        if r.g != last:
            total = xor = place = 0
            before = None
        total, xor = total + r.v, xor ^ r.v
        assert (r.place, r.sum_v, r.xor_v, r.lag_v) == (place, total, xor, before)
        last, before, place = r.g, r.v, place + 1


def measured(text):
    text = text or ""
    words = brute.WORD.findall(text)
    lines = [line for line in text.split("\n") if brute.WORD.search(line)]
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_upper": sum("A" <= c <= "Z" for c in text), "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
    }


def test_rules(spark, documents, nothing):  # noqa: F811
    more = [(900, "SHOUT " * 12), (901, "# $ % & | < > * a b c d"), (902, "same line\n" * 6 + "other words to be read"),
            (903, "x" * 600 + " b c d e f g h i j"), (904, "é" * 30 + "\x0b  a\n\n \n")]
    extra = spark.createDataFrame(more, "doc_id bigint, text string")
    frame = documents.select("doc_id", "text").union(extra)
    rows = [(i, t) for i, t, *_ in texts()] + more
    ledger = evaluate_rules(frame)
    expected = []
    for i, text in rows:
        m = measured(text)
        bits = sum(1 << k for k, rule in enumerate(RULES.values()) if eval(rule, {}, m))
        expected.append((i, *(m[name] for name in MEASURES), bits))
    assert Counter(tuple(r) for r in ledger.collect()) == Counter(expected)
    kept = ledger.filter(passes(BASE)).count()
    assert kept == sum(bits & BASE.mask == 0 for *_, bits in expected)
    policies = [BASE, STRICT, Policy("none-but-one", ("capitals",))]
    found = {(r.version, r.rule): r[2:] for r in ablations(ledger, policies).collect()}
    every = [bits for *_, bits in expected]
    for policy in policies:
        for rule in policy.rules:
            bit = 1 << list(RULES).index(rule)
            failed = [b & policy.mask for b in every]
            assert found[policy.version, rule] == (
                len(every), failed.count(0), sum(b & bit > 0 for b in failed), failed.count(bit),
                sum(b & ~bit == 0 for b in failed),
            )
    assert evaluate_rules(nothing).count() == 0
    assert {tuple(r[2:]) for r in ablations(evaluate_rules(nothing), policies).collect()} == {(0, 0, 0, 0, 0)}
