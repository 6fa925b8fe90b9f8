"""Words are encoded as the tokenizer encodes them, with few steps a word."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa

from lakeweir.llm.packing import pack
from lakeweir.llm.tokens import WordEncoder

TEXTS = ["plain", "Plain, words", "a<|endoftext|>b", "K k", "don't 'S ''s !'s", "àÉ 1a2 x_y", "x" * 99]


def test_ids_are_those_of_the_tokenizer():
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    for texts in (TEXTS, TEXTS[::-1]):
        for text in texts:
            ((_, ids, _),) = encoder.encode(pa.array([text]))
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2]


def test_a_word_that_is_a_known_piece_is_not_split_again(monkeypatch):
    encoder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), None)
    first = encoder.word(b"Stone")
    monkeypatch.setattr("lakeweir.llm.tokens.PIECE", None)
    assert encoder.word(b"stone") == encoder.word(b"STONE") == first


def test_the_driver_loads_no_tokenizer_to_pack(spark, monkeypatch):
    loaded = {}
    monkeypatch.setattr("lakeweir.llm.tokens._ENCODERS", loaded)
    docs = spark.createDataFrame([(1, "some words"), (2, None), (3, "x" * 40)], "doc_id int, text string")
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2, length=4).collect()
    assert {p["id"] for p in pieces} == {1, 2, 3}
    assert all(len(p["ids"]) == 4 * p["length"] for p in pieces)
    assert sum(p["length"] for p in pieces if p["id"] == 2) == 1
    assert not loaded
