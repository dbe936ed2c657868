"""Operator 7 against all pairs by brute force."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesora.llm import near_dup, queries

DATA = "/root/testdata/sf0.001"


def sets_of(text, width):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent):
    held = [(i, sets_of(text, width)) for i, text in rows]
    root = {i: i for i, _ in held if i is not None}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in combinations([x for x in held if x[1] and x[0] is not None], 2):
        if 100 * len(a & b) >= percent * len(a | b) and top(i) != top(j):
            root[max(top(i), top(j))] = min(top(i), top(j))
    return sorted(((i, len(s), top(i), top(i) == i) if i is not None else (None, len(s), None, True) for i, s in held), key=str)


def family(rng, n):
    """Near copies of a few texts, many close to the threshold."""
    rows = []
    for i in range(n):
        base = [f"w{(i % 3) * 1000 + k}" for k in range(60)]
        for _ in range(rng.randrange(9)):
            base[rng.randrange(60)] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(base)))
    return rows


@pytest.mark.parametrize("width,chunk", [(2, 256), (5, 8)])
def test_components_equal_brute_force(spark, monkeypatch, width, chunk):
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    rng = random.Random(width)
    rows = family(rng, 120) + [(500, None), (501, ""), (502, " \n"), (503, "One"), (504, "one"), (505, "one two"), (506, "One\ttwo"), (507, "Éa b"), (508, "éa b")]
    rows += [(600 + i, "same text " * 3) for i in range(40)] + [(None, "same text " * 3), (3, rows[3][1]), (700, "long word " * 30_000), (701, "long word " * 30_000)]
    df = spark.createDataFrame([(i, text, "x") for i, text in rows], "doc_id long, text string, component_id string")
    assert sorted(map(tuple, near_dup.near_duplicates(df, width, 80).collect()), key=str) == brute(rows, width, 80)
    assert near_dup.near_duplicates(df.limit(0), width).count() == 0


def test_two_texts_of_one_doc_id_keep_the_links_of_both(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "CHUNK", 16)
    rng = random.Random(9)
    rows = family(rng, 60)
    rows += [(i, " ".join(f"z{i % 5}_{k}" if k >= 3 * (i % 7) % 20 else f"y{i}_{k}" for k in range(60))) for i in range(0, 60, 3)] + rows[:5]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, near_dup.near_duplicates(df, 2, 80).collect()), key=str) == brute(rows, 2, 80)


def test_the_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    assert sorted(map(tuple, queries.op7_minhash_components(spark, DATA).collect()), key=str) == brute(rows, 2, 80)


@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=25))
@settings(max_examples=6, deadline=None)
def test_stars_find_the_components(spark, edges):
    got = {r.node: r.component for r in near_dup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(13):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    assert got == {x: r for x, r in root.items() if x != r}
