"""Nulls, empty and long texts, repeated rows, ties, empty tables and clashing column names."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from lakeweir.llm import chat, quality, toxicity
from lakeweir.llm.bitmaps import build_bitmap, perhaps_in
from lakeweir.llm.components import connected_components
from lakeweir.llm.decontamination import find_benchmark
from lakeweir.llm.embedding_dedup import fit_forest, fit_forests, near_vectors
from lakeweir.llm.ngram_join import crowd_rows, near_duplicates
from lakeweir.llm.packing import pack
from lakeweir.llm.storage import Workspace
from lakeweir.llm.substring_dedup import remove_repeats
from lakeweir.llm.token_counts import apply_edits, count_tokens
from lakeweir.llm.tokens import WordEncoder
from lakeweir.llm.warc import id_of, read_archive, write_archive
from lakeweir.llm.words import ALNUM_LOWER, NOT_SPACE, hash_words, ngrams, split, window_minima
from tests.llm import brute

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, id string"
PASSAGE = " ".join(f"word{i}" for i in range(60))


def texts() -> list[tuple]:
    """Documents with every awkward case; ids are unique but for a repeated row and nulls."""
    rng = random.Random(5)
    some = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))) for _ in range(30)]
    some += [some[0], some[1] + " x", "", " \n\t ", None, "a b", "a b", "A B", "one two three four five"]
    some += [PASSAGE, f"start {PASSAGE} end", PASSAGE + " " + PASSAGE, "a " * 500, "x" * 5000]
    some += [" ".join(f"long{i}" for i in range(30_000)), "É Ünïcode ŒUVRE  　 日本 語", "a\x00b"]
    rows = [(i, t) for i, t in enumerate(some)]
    rows += [(2, some[2]), (None, "null id text"), (None, None)]
    return [(i, t, None, "s", len(t or ""), "clash", "clash") for i, t in rows]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(texts(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_words_and_windows():
    rows = [t for _, t, *_ in texts()]
    for table, lower, pattern in ((NOT_SPACE, False, brute.WORD), (ALNUM_LOWER, True, brute.ALNUM)):
        found, hashes = [], {}
        for w in split(pa.array(rows, pa.string()), table, lower=lower, limit=2000):
            data = w.buf.tobytes()
            h1, h2 = hash_words(w)
            words = [data[s:e].decode() for s, e in zip(w.start, w.end)]
            for word, *h in zip(words, h1, h2):
                assert hashes.setdefault(word, h) == h
            found += [words[a:b] for a, b in zip(w.first[:-1], w.first[1:])]
        assert found == [pattern.findall(brute.lower(t) if lower else t or "") for t in rows]
        assert len({tuple(h) for h in hashes.values()}) == len(hashes)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 16, 20])
def test_ngrams_and_minima(n):
    h = np.random.default_rng(n).integers(0, 4, 200).astype(np.uint64)
    grams = ngrams(h, n)
    known: dict = {}
    for i in range(len(h) - n + 1):
        run = tuple(h[i : i + n])
        assert known.setdefault(run, grams[i]) == grams[i]
    assert len(set(known.values())) == len(known)
    value, place = window_minima(h, n)
    for i in range(len(h) - n + 1):
        assert value[i] == h[i : i + n].min() and place[i] == i + h[i : i + n].argmin()


def test_bitmap(spark):
    rng = np.random.default_rng(1)
    inside, outside = rng.integers(-(2**63), 2**63 - 1, (2, 3000))
    bitmap = build_bitmap(spark.createDataFrame([(int(x),) for x in inside], "h bigint"), "h").value
    assert perhaps_in(bitmap, inside.view(np.uint64)).all()
    assert perhaps_in(bitmap, outside.view(np.uint64)).mean() < 0.01


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(80)]
    links += [(7, 7)]
    pairs = {frozenset(link) for link in links}
    nodes = sorted({n for link in links for n in link})
    expected = brute.components(nodes, lambda a, b: frozenset((a, b)) in pairs)
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    for edges_per_task in (200_000, 40):
        found = connected_components(frame, Workspace(spark, "test"), edges_per_task).collect()
        got = {r.node: r.component for r in found}
        assert len(found) == len(got) and got == {n: c for n, c in expected.items() if n in got}
        alone = {n for n in nodes if list(expected.values()).count(expected[n]) == 1}
        assert set(nodes) - set(got) == alone


def test_near_duplicates(documents, nothing):
    found = near_duplicates(documents).collect()
    assert len(found) == documents.count()
    expected = brute.near_duplicates({i: t for i, t, *_ in texts() if i is not None})
    for r in found:
        if r.id is not None:
            assert r.component_id == expected[r.id]
    sizes = {i: len(brute.shingles(t)) for i, t, *_ in texts() if i is not None}
    assert all(r.n_shingles == sizes[r.id] for r in found if r.id is not None)
    assert near_duplicates(nothing).count() == 0


def test_near_duplicate_families(spark):
    """Families of near copies at all distances, so that every round of the join has work."""
    rng = random.Random(11)
    rows = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(40):
            copy = list(base)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = f"new{rng.random()}"
            rows.append(" ".join(copy[rng.randint(0, 12) :]))
    expected = brute.near_duplicates(dict(enumerate(rows)))
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(4)
    assert {r.id: r.component_id for r in near_duplicates(frame).collect()} == expected


def test_an_id_with_several_texts_is_one_node(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(20)) for c in "abc")
    rows = [(3, one), (5, one), (5, two), (7, two), (9, three), (8, three), (9, one), (10, ""), (5, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {(r.id, r.n_shingles): r.component_id for r in near_duplicates(frame).collect()}
    # Without words a row is linked with nothing.
    assert found == {(3, 16): 3, (5, 16): 3, (7, 16): 3, (8, 16): 3, (9, 16): 3, (10, 0): 10, (5, 0): 5}


def test_crowded_buckets_do_not_overflow():
    batch = pa.RecordBatch.from_arrays([pa.array(["a " * 70_000])], names=["text"])
    out = pa.Table.from_batches(crowd_rows(5)(iter([batch])))
    assert out.column("n").to_pylist() == [65_535]


def test_remove_repeats(documents, nothing):
    found = remove_repeats(documents).collect()
    assert len(found) == documents.count()
    expected = brute.kept_words({i: t for i, t, *_ in texts() if i is not None})
    for r in found:
        if r.id is not None:
            assert r.kept == " ".join(expected[r.id])
            assert r.n_words - r.n_removed == len(expected[r.id])
    assert remove_repeats(nothing).count() == 0


def test_find_benchmark(spark, documents, nothing):
    items = [(1, " ".join(PASSAGE.split()[5:30])), (2, "a b"), (3, ""), (4, None), (5, "日本"), (1, "null id")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    one = {(k, n): t for n, (k, t) in enumerate(items)}
    found = find_benchmark(documents, bench).collect()
    assert len(found) == documents.count()
    rows = {i: t for i, t, *_ in texts() if i is not None}
    for r in found:
        n, hit, keys = brute.benchmark_hits(rows.get(r.id, ""), one)
        if r.id is not None:
            assert (r.n_words, r.n_hit, sorted(r.items)) == (n, len(hit), sorted({k for k, _ in keys}))
            assert {w for s in r.spans for w in range(s.start, s.stop)} == hit
    assert find_benchmark(nothing, bench).count() == 0
    clean = find_benchmark(documents, bench.limit(0)).collect()
    assert len(clean) == documents.count() and not any(r.n_hit for r in clean)


def test_find_benchmark_without_item_id(spark, nothing):
    words = PASSAGE.split()
    items = [(None, " ".join(words[:15])), (None, " ".join(words[20:32])), (4, " ".join(words[40:]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = [(1, " ".join(words[:35])), (2, PASSAGE), (3, "other words"), (4, " ".join(words[40:]))]
    found = find_benchmark(spark.createDataFrame(docs, "doc_id bigint, text string"), bench)
    got = {r.id: (r.n_hit, sorted(r["items"], key=str)) for r in found.collect()}
    assert got == {1: (27, [None]), 2: (47, [4, None]), 3: (0, []), 4: (20, [4])}


def test_pack(documents, nothing):
    pieces = pack(documents, TOKENIZER, 2, length=64).collect()
    place = 0
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 64 + p.offset == place and len(p.ids) == 4 * p.length
        place += p.length
    assert place == sum(len(brute.ids_of(t)) + 1 for _, t, *_ in texts())
    assert pack(nothing, TOKENIZER, 2).count() == 0


def test_encoder_on_odd_texts():
    rng = random.Random(0)
    letters = "abcXYZ019'sdlvet.,<|> \u0085éÉİΣσ́ẞ一\U0001f600٣²×ƻ_-\x1c \n"
    rows = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    rows += ["<|endoftext|>a<|endoftext|> b'll don't", None, ""]
    got = []
    for _, flat, bounds in WordEncoder(TOKENIZER, None).encode(pa.array(rows)):
        got += [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [brute.ids_of(t) for t in rows]


def test_encoder_on_letters_with_distant_lower_case():
    rows = ["a\u023ab", "\u023e", "x\u023e\u023ay1", "\u0239\u023b\u023d\u023f"]
    got = []
    for _, flat, bounds in WordEncoder(TOKENIZER, None).encode(pa.array(rows)):
        got += [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    assert got == [brute.ids_of(t) for t in rows]


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(40, 16))
    vectors = [(c + rng.normal(size=16) * s).tolist() for c in centers for s in (0, 0, 0.05, 0.1, 0.2)]
    vectors += [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16]
    vectors += [[1.0, 0.0], [1.0, 0.01], [1e300] * 16, [1e-300] * 16]
    rows = list(enumerate(vectors))
    schema = "vec_id bigint, embedding array<double>, n string"
    frame = spark.createDataFrame([(i, v, "clash") for i, v in rows], schema).repartition(3)

    def good(v):
        return bool(v) and None not in v and np.isfinite(v).all() and any(v)

    unit = {}
    for i, v in rows:
        if good(v):
            scaled = np.array(v) / np.abs(v).max()
            unit[i] = scaled / np.linalg.norm(scaled)

    def linked(a, b):
        same = a in unit and b in unit and len(unit[a]) == len(unit[b])
        return same and unit[a] @ unit[b] >= 0.95

    ids = [i for i, _ in rows]
    expected = brute.components(ids, linked)
    for block in (2048, 16):
        found = near_vectors(frame, leaf=40, block=block).collect()
        assert len(found) == len(rows)
        links = {i: sum(linked(i, j) for j in ids if j != i) for i in ids}
        right = sum(r.n_links == links[r.id] for r in found)
        assert all(r.n_links <= links[r.id] for r in found)
        assert right >= 0.95 * len(rows)
        assert sum(r.component_id == expected[r.id] for r in found) >= 0.95 * len(rows)
    assert near_vectors(frame.limit(0)).count() == 0


def test_a_stray_longer_vector_leaves_the_forest(spark):
    vectors = np.random.default_rng(6).normal(size=(400, 64)).tolist() + [[1.0] * 65]
    rows = [(len(v), i, v) for i, v in enumerate(vectors)]
    classes = spark.createDataFrame(rows, "dim int, id bigint, vector array<double>")
    forests = fit_forests(classes, cosine=0.95, trees=4, leaf=40, max_sample=1000)
    assert list(forests) == [64] and all(forests[64].nodes)


def test_forest_keeps_a_dense_group():
    """A third of the vectors in one group of mean pair cosine 0.95, the rest far from each other."""
    rng = np.random.default_rng(8)

    def unit(v):
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    center = unit(rng.normal(size=(1, 64)))
    group = np.sqrt(0.95) * center + np.sqrt(0.05) * unit(rng.normal(size=(2000, 64)))
    vectors = unit(np.concatenate([group, rng.normal(size=(4000, 64))]))
    linked = group @ group.T >= 0.95
    forest = fit_forest(vectors, len(vectors), cosine=0.95, trees=4, leaf=100)
    met = np.zeros(linked.shape, bool)
    for tree in range(len(forest.nodes)):
        rows, leaves = forest.leaves(vectors[:2000], tree)
        _, leaf = np.unique(leaves, return_inverse=True)
        member = np.zeros((2000, leaf.max() + 1), np.float32)
        member[rows, leaf] = 1
        met |= member @ member.T > 0
    assert (met & linked).sum() >= 0.999 * linked.sum()


def test_archive(spark):
    big, small = "ä" * 600, "tiny"
    rows = [
        (1, "http://a", big), (2, "http://b\r\nX: y", big), (3, None, big), (4, "http://d", small),
        (5, "http://e", small), (6, "u", None), (7, "u", ""), (None, "u", big), (3, None, big),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    found = read_archive(write_archive(pages)).select("*", id_of("refers_to", "bigint").alias("to")).collect()
    assert len(found) == len(rows)
    for r in found:
        revisit = r.id in (1, 2, None)
        assert (r.record_type, r.to) == (("revisit", 3) if revisit else ("response", None))
        header, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        assert header.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n") and b"\nX: y" not in header
        size = int(header.split(b"Content-Length: ")[1])
        assert len(rest) == size + 4
        digest = hashlib.sha1(r.payload).hexdigest().encode()
        assert b"WARC-Payload-Digest: sha1:" + digest in header
        if not revisit:
            assert rest[:-4].endswith(r.payload)
    assert read_archive(write_archive(pages.limit(0))).count() == 0


def test_classifiers(spark, documents, nothing):
    labels = spark.createDataFrame(
        [(i, i % 2, i % 3 == 0, "x") for i in range(30)] + [(None, 1, True, "x"), (3, None, None, "x")],
        "doc_id bigint, quality int, flag boolean, text string",
    ).selectExpr("doc_id", "quality", "cast(flag as int) as toxic", "text")
    model = quality.train(documents, labels)
    scored = quality.score_quality(documents, model).collect()
    assert len(scored) == documents.count() and all(0 <= r.score <= 1 for r in scored)
    models = toxicity.train(documents, labels)
    scored = toxicity.score_toxicity(documents, models).collect()
    assert len(scored) == documents.count() and all(0 <= r.score <= 1 for r in scored)
    blank = quality.train(documents, labels.limit(0))
    assert {r.score for r in quality.score_quality(documents, blank).collect()} == {0.5}
    unlabelled = toxicity.train(documents, labels.limit(0))
    assert len({r.score for r in toxicity.score_toxicity(documents, unlabelled).collect()}) == 1
    assert quality.score_quality(nothing, blank).count() == 0
    assert toxicity.score_toxicity(nothing, models).count() == 0
    assert toxicity.score_toxicity(documents, toxicity.train(nothing, labels)).count() == documents.count()


def test_transcripts_in_parts(spark):
    rng = random.Random(2)
    rows, role = [], "user"
    for i in range(400):
        mark = {"user": "User: ", "assistant": "Bot: "}[role] if rng.random() < 0.8 else ""
        size = rng.randint(1, 8) if role == "user" else rng.randint(60, 90)
        rows.append((1 if i < 300 else i // 7, i, role, None, f"\n{mark}" + "so " * size + "\nand more"))
        role = "assistant" if role == "user" else "user"
    turns = spark.createDataFrame(rows, "id bigint, seq bigint, role string, before string, text string")
    model = chat.train(turns)
    extra = [(None, 1, "user", None, "User: hi"), (9999, None, "user", None, None), (1, 0, *rows[0][2:])]
    turns = turns.union(spark.createDataFrame(extra, turns.schema))

    def parsed(limit):
        found = chat.parse_transcripts(turns, model, part_rows_limit=limit).collect()
        return {(r.id, r.seq): (r.roles, r.rendered) for r in found}

    whole = parsed(10_000)
    assert len(whole) == 402 and parsed(25) == whole
    assert whole[None, 1][1] == "<|user|>\nhi<|end|>\n" and whole[9999, None] == ([], "")
    right = [whole[i, s][0] == [r] for i, s, r, *_ in rows]
    assert np.mean(right) > 0.9
    assert chat.parse_transcripts(turns, model).count() == turns.count() == 403
    assert chat.parse_transcripts(turns.limit(0), model).count() == 0


def test_each_copy_of_a_piece_has_its_row(spark, monkeypatch):
    rows = [(1, 0, "User: hi\n")] * 50 + [(1, 1, "Bot: ho")] * 3 + [(2, 0, None)] * 2 + [(2, 1, "x")]
    turns = spark.createDataFrame(rows, "id bigint, seq bigint, text string").repartition(3)
    model = chat.train(spark.createDataFrame([(None, "user", "User: a"), ("user", "assistant", "Bot: b")],
                                             "before string, role string, text string"))
    plain = sorted(map(repr, chat.parse_transcripts(turns, model).collect()))
    monkeypatch.setattr(chat, "COPIES", 7)
    dealt = chat.parse_transcripts(turns, model)
    assert sorted(map(repr, dealt.collect())) == plain and len(plain) == len(rows)


def test_edits(spark, documents, nothing):
    rng = random.Random(8)
    rows = {i: t for i, t, *_ in texts() if i is not None}
    edits = [
        (i, rng.randint(-2, 300), rng.randint(-2, 320), rng.choice(["", " ", "new word", None]))
        for i in rows for _ in range(rng.randint(0, 4))
    ]
    edits += [(10**9, 0, 1, "unknown"), (3, None, None, None)]
    frame = spark.createDataFrame(edits, "doc_id bigint, start bigint, stop bigint, value string")
    state = count_tokens(documents, TOKENIZER, leaf_words=3)
    found = apply_edits(documents, state, frame, TOKENIZER, keep_text=True).collect()
    assert len(found) == documents.count()
    for r in found:
        assert r.n_tokens == r.tree[1] == len(brute.ids_of(r.text))
        assert sum(r.leaf_chars) == len(r.text)
        if r.id is not None:
            assert r.n_before == len(brute.ids_of(rows[r.id]))
    assert apply_edits(nothing, state, frame, TOKENIZER).count() == 0


def test_pipeline_drops_copies_without_id(spark, tmp_path):
    """Families with rows without id, unrelated texts without id or with one id, texts without words."""
    one, two, three, four, five = (" ".join(f"{c}{i}" for i in range(30)) for c in "abcde")
    rows = [(1, one), (None, one), (3, one + " x"), (None, two), (7, two), (8, two), (None, three)]
    rows += [(None, three), (5, four), (5, five), (6, five), (9, ""), (9, ""), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, str(tmp_path))
    expected = [(1, one), (7, two), (None, three), (5, four), (5, five), (9, ""), (None, "")]
    assert kept.columns == frame.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, expected))


def test_pipeline_on_awkward_rows(spark, documents, nothing, tmp_path):
    for name, frame in (("full", documents), ("empty", nothing)):
        base = tmp_path / name
        frame.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string").write.parquet(f"{base}/benchmark.parquet")
        pieces = corpus_pipeline.run(spark, str(base)).collect()
        assert bool(pieces) == (name == "full")
    kept = {p.doc_id for p in pieces} if pieces else set()
    assert not kept
