"""Operators 1 and 5 against the tokenizers library and exact round trips."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tesora.llm import bitplane, queries, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "", None, " \t\n", "Don't we'll I'D", "x<|endoftext|>y <|startoftext|>", "<|endoftext", "<|endoftext|>\u0338", "café café ÇÉ", "ΣΑΣ ὈΔΥΣΣΕΎΣ",
    "a b c\x1cd\x85e", "١٢٣ Ⅷ ² 一二三", "İstanbul ǅ ß", "👩‍👩‍👧 !!??", "thththth" * 300, "wörd " * 5000, "́x", "'s 't 're''ve",
]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(st.characters(exclude_categories=("Cs", "Cn"))), st.text(alphabet="abΣσéÉ'<|endoftext|> \t\n\xa0!1²", max_size=60)))
def test_both_equal_the_library_on_any_text(text):
    expected = ids(text)
    assert token_counts.counts_of(PATH).text(text.encode()) == len(expected)
    assert bitplane.ids_of(PATH).texts([text.encode()])[0] == np.array(expected, "<u4").tobytes()


def test_runs_of_letters_go_to_the_model_alone(monkeypatch):
    encoder = bitplane.Ids(PATH)
    texts = ["Straße naïve ÑANDÚ œuvre жизнь ΛΌΓΟΣ", "words, \"Quoted\" (naïve) end."]
    joined = []
    monkeypatch.setattr(encoder, "learn_pieces", lambda pieces, learn=encoder.learn_pieces: (joined.extend(pieces), learn(pieces)))
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts([text.encode() for text in texts])] == [ids(text) for text in texts]
    assert encoder.by_model and not [piece for piece in joined if piece.isalpha()]


def test_a_full_store_loses_no_words(monkeypatch):
    monkeypatch.setattr(bitplane, "CACHE", 6)
    encoder, texts = bitplane.Ids(PATH), ["one two three four", "two five! six seven one", "eight one nine two", "", "one"]
    for _ in range(2):
        for part in (texts[:2], texts[1:]):
            assert [np.frombuffer(x, "<u4").tolist() for x in encoder.texts([text.encode() for text in part])] == [ids(text) for text in part]


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(["bytes", "bits"]), st.integers(1, 64), st.data())
@settings(max_examples=150, deadline=None)
def test_planes_round_trip_whole_and_in_part(values, planes, block, data):
    array = np.array(values, "<u4")
    packed, begins = bitplane.pack(array, planes, block)
    assert bitplane.unpack(packed, begins, len(array), planes, block=block).tolist() == values
    lo = data.draw(st.integers(0, len(values)))
    hi = data.draw(st.integers(lo, len(values)))
    assert bitplane.unpack(packed, begins, len(array), planes, lo, hi, block).tolist() == values[lo:hi]


@pytest.fixture
def odd(spark):
    rows = [(i, text, "en", i) for i, text in enumerate(ODD)] + [(3, ODD[3], "en", 3), (None, "no id", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_chars long")


def test_counts_of_odd_documents(odd):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd, PATH, 100).collect())
    expected = sorted(
        (r.doc_id is not None, r.doc_id or 0, len((r.text or "").encode()), len(ids(r.text)), len(ids(r.text)) > 100) for r in odd.collect()
    )
    assert got == expected


@pytest.mark.parametrize("planes", ["bytes", "bits"])
def test_files_hold_every_document_in_order(odd, planes):
    got = bitplane.round_trip(odd, PATH, planes=planes).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in odd.collect()), key=lambda x: (x is not None, x))
    at, texts = 0, {r.doc_id: r.text for r in odd.collect()}
    for r in got:
        expected = [*ids(texts[r.doc_id]), 1]
        assert (r.start, r.n_tokens, r.ids) == (at, len(expected), struct.pack(f"<{len(expected)}I", *expected))
        at += len(expected)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, PATH).count() == 0
    assert bitplane.round_trip(none, PATH).count() == 0


def test_queries_equal_the_library_on_whole_tables(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    start, expected = {}, {}
    at = 0
    for name in sorted(docs):
        expected[name], start[name] = [*ids(docs[name]), 1], at
        at += len(expected[name])
    got = queries.op1_token_planes(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        data = struct.pack(f"<{len(expected[r.doc_id])}I", *expected[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start[r.doc_id], len(expected[r.doc_id]), zlib.crc32(data))
    counted = queries.op5_token_counts(spark, "/root/testdata/sf0.001")
    assert {r.doc_id: r.n_tokens for r in counted.collect()} == {name: len(x) - 1 for name, x in expected.items()}
    assert counted.filter(F.col("over_limit") != (F.col("n_tokens") > 2048)).count() == 0
