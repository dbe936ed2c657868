"""Operator 9 against windows written out, and the index against plain search."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesora.llm import queries, substrings

DATA = "/root/testdata/sf0.001"


def brute(rows, width=13):
    least = {}
    split = [(i, (text or "").encode().split()) for i, text in rows]
    for i, words in split:
        if i is not None:
            for k in range(len(words) - width + 1):
                w = tuple(words[k : k + width])
                least[w] = min(i, least.get(w, i))
    found = []
    for i, words in split:
        away = [False] * len(words)
        for k in range(len(words) - width + 1):
            if i is not None and least[tuple(words[k : k + width])] < i:
                away[k : k + width] = [True] * width
        kept = b" ".join(w for w, x in zip(words, away) if not x)
        found.append((i, len(words), sum(away), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


@given(st.lists(st.integers(0, 4), max_size=80), st.lists(st.lists(st.integers(1, 6), min_size=5, max_size=5), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_backward_search_counts_and_matches(text, patterns):
    text = [*text, 0]  # sequences end in 0, which stands in no pattern
    array = np.array(text, np.int64)
    index = substrings.FMIndex(array, np.arange(len(text)), 5)
    length, lo, hi = index.search(np.array(patterns))
    for row, pattern in enumerate(patterns):
        def places(n):
            tail = pattern[5 - n :]
            return [k for k in range(len(text) - n + 1) if text[k : k + n] == tail]

        expected = max((n for n in range(6) if n == 0 or places(n)), default=0)
        assert length[row] == expected
        if expected:
            assert sorted(index.figure[lo[row] : hi[row]].tolist()) == places(expected)
            assert index.least(lo[row : row + 1], hi[row : row + 1])[0] == min(places(expected))


@pytest.mark.parametrize("hot,shard_words", [(1000, 200_000), (2, 300)])
def test_removal_equals_brute_force(spark, monkeypatch, hot, shard_words):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard_words)
    rng = random.Random(hot)
    words = [f"w{k}" for k in range(300)]
    passages = [rng.choices(words, k=rng.randrange(10, 70)) for _ in range(6)]
    rows = []
    for i in range(150):
        text = rng.choices(words, k=rng.randrange(0, 40))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            a = rng.randrange(len(passage))
            text[rng.randrange(len(text) + 1) : 0] = passage[a : a + rng.randrange(5, 60)]
        rows.append((rng.randrange(10_000), " ".join(text)))
    rows += [(20_000 + k, " ".join(passages[0])) for k in range(20)] + [(7, "la " * 60), (9, "la " * 40), (8, "x y " * 9_000)]
    rows += [(1, None), (2, ""), (3, "\n \t"), (None, " ".join(passages[1])), (20_000, " ".join(passages[0])), (20_003, " ".join(passages[2]) + " tail")]
    rows += [(30_000, "  ".join(passages[3])), (30_001, "\n".join(passages[3]))]
    df = spark.createDataFrame([(i, text, "x") for i, text in rows], "doc_id long, text string, n_words string")
    got = substrings.removal_digests(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    whole = substrings.remove_repeats(df).collect()
    assert sorted((tuple(r)[:4] for r in whole), key=str) == brute(rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in whole)
    assert substrings.removal_digests(df.limit(0)).count() == 0


def test_the_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    assert sorted(map(tuple, queries.op9_fm_index(spark, DATA).collect()), key=str) == brute(rows)
