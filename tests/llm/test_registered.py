"""Registered queries against SQL, brute force or held-out labels, on small tables."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from lakeweir.llm.queries import QUERIES, derived_edits, read
from tests.llm import brute
from tests.oracle import connect, difference

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
BY_NAME = {q.name: q for q in QUERIES}


def test_one_query_per_operator():
    numbers = [int(n[2:].split("_")[0]) for n in BY_NAME if n.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in BY_NAME


@pytest.mark.parametrize("name", [q.name for q in QUERIES if q.sql])
def test_equals_sql(spark, name):
    query = BY_NAME[name]
    assert difference(query.run(spark, SMALL), query.sql, connect(SMALL)) is None


@pytest.mark.parametrize(
    "name, column, modulus, held", [("op1_toxicity", "toxic", 3, 1), ("op5_quality", "quality", 5, 0)]
)
def test_held_out_labels(spark, name, column, modulus, held):
    scored = BY_NAME[name].run(spark, MIDDLE).toPandas()
    documents = read(spark, MIDDLE, "documents").toPandas()
    assert sorted(scored.doc_id) == sorted(documents.doc_id)
    assert scored.score.between(0, 1).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % modulus == held for i in scored.doc_id]).all()
    labels = read(spark, MIDDLE, "labels").toPandas()
    rows = scored[scored.held_out].merge(labels, on="doc_id")
    # Share of pairs of a positive and a negative that are in the right order.
    high, low = rows[rows[column] == 1].score.values, rows[rows[column] == 0].score.values
    above = (high[:, None] > low).mean() + 0.5 * (high[:, None] == low).mean()
    assert above > 0.85
    assert (rows.predicted == rows[column]).mean() > 0.9


def check_pieces(pieces: pd.DataFrame, texts: dict) -> None:
    pieces = pieces.sort_values(["sequence_id", "offset"])
    place = pieces.sequence_id * 4096 + pieces.offset
    assert (place == np.concatenate([[0], np.cumsum(pieces.length)[:-1]])).all()
    assert (pieces.offset + pieces.length <= 4096).all()
    ids = {i: np.array(brute.ids_of(t) + [2], "<u4") for i, t in texts.items()}
    for p in pieces.itertuples():
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert (p.doc_tokens, p.length) == (len(ids[p.doc_id]), len(part))
        assert zlib.crc32(part.tobytes()) == p.ids_crc32
    assert pieces.groupby("doc_id").length.sum().to_dict() == {i: len(v) for i, v in ids.items()}


def test_packing(spark):
    documents = read(spark, SMALL, "documents").toPandas()
    check_pieces(
        BY_NAME["op2_packing"].run(spark, SMALL).toPandas(), dict(zip(documents.doc_id, documents.text))
    )


def test_transcripts(spark):
    found = BY_NAME["op7_chat"].run(spark, MIDDLE).toPandas()
    turns = read(spark, MIDDLE, "conversations").toPandas()
    rows = found.merge(turns, on=["conv_id", "turn"])
    assert len(found) == len(turns) == len(rows)
    right = [list(a) == [b] for a, b in zip(rows.roles, rows.role)]
    assert np.mean(right) > 0.95
    whole = "".join(found[found.conv_id == 0].sort_values("turn").rendered)
    assert whole.startswith("<|") and whole.endswith("<|end|>\n")


def edited(text: str, edits: list) -> str:
    out, at = [], 0
    for e in sorted(edits):
        start = min(max(e[0], 0), len(text))
        stop = max(start, min(e[1], len(text)))
        if start >= at:
            out += [text[at:start], e[2]]
            at = stop
    return "".join(out) + text[at:]


def test_token_counts(spark):
    documents = read(spark, SMALL, "documents")
    edits: dict = {}
    for e in derived_edits(documents).collect():
        edits.setdefault(e.doc_id, []).append((e.start, e.stop, e.value))
    counts = BY_NAME["op10_token_counts"].run(spark, SMALL).toPandas().set_index("doc_id")
    for d in documents.collect():
        got = counts.loc[d.doc_id]
        assert got.n_before == len(brute.ids_of(d.text))
        assert got.n_tokens == len(brute.ids_of(edited(d.text or "", edits[d.doc_id])))
    assert counts.n_encoded.sum() < 0.6 * counts.n_tokens.sum()


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, against brute force."""
    docs = read(spark, SMALL, "documents")
    items = {b.item_id: b.text for b in read(spark, SMALL, "benchmark").collect()}
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r for r in BY_NAME["op5_quality"].run(spark, SMALL).collect()}
    expected = {i: r.text for i, r in rows.items() if scores[i].predicted == 1}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if name == "near_duplicates":
            roots = brute.near_duplicates(expected)
            expected = {i: t for i, t in expected.items() if roots[i] == i}
        elif name == "substring_dedup":
            kept = brute.kept_words(expected)
            expected = {
                i: t if len(kept[i]) == len(brute.WORD.findall(t or "")) else " ".join(kept[i])
                for i, t in expected.items()
            }
        elif name == "decontamination":
            expected = {i: t for i, t in expected.items() if not brute.benchmark_hits(t, items)[1]}
        if name == "packing":
            pieces = docs.toPandas()
            pieces["ids_crc32"] = [zlib.crc32(i) for i in pieces.ids]
            check_pieces(pieces, expected)
        else:
            found = docs.collect()
            assert docs.columns == columns
            assert {r.doc_id: r.text for r in found} == expected and len(found) == len(expected)
            docs = spark.createDataFrame(found, docs.schema)
    assert 0 < len(expected) < len(rows)
