"""Operator 3: targets, draws and permutations by plain arithmetic, and what the whole mix takes."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tesora.llm import mixing, queries

SMALL = "/root/testdata/sf0.001"
NAMES = st.one_of(st.none(), st.text(max_size=3))


@given(st.dictionaries(NAMES, st.integers(0, 10_000), max_size=12))
@settings(max_examples=200, deadline=None)
def test_targets_share_everything_and_stop_at_three_times(sizes):
    got = mixing.targets(sizes)
    assert math.isclose(sum(s.target for s in got), sum(sizes.values()), abs_tol=1e-6)
    assert [s.weight for s in got] == [1 + i % 3 for i in range(len(got))]
    assert [s.name for s in got] == sorted(sizes, key=lambda x: (x is None, [ord(c) for c in x or ""]))
    free = [s.target / s.weight for s in got if s.target < 3 * s.size - 1e-9]
    assert all(s.target <= 3 * s.size + 1e-9 for s in got)
    # Those below their limit have one rate, and nobody who stopped has a higher one.
    assert not free or (max(free) - min(free) < 1e-6 and all(s.target / s.weight <= min(free) + 1e-6 for s in got))


@given(st.integers(1, 3000), st.integers(0, 2**60))
@settings(max_examples=100, deadline=None)
def test_permutations_are_permutations(n, key):
    got = mixing.permuted(np.arange(n), n, np.full(n, key, np.uint64))
    assert sorted(got.tolist()) == list(range(n))


@given(st.lists(st.integers(0, 400), min_size=1, max_size=8), st.integers(1, 30))
@settings(max_examples=100, deadline=None)
def test_draws_add_up_to_the_quotas(quotas, shards):
    held = np.zeros(len(quotas), np.int64)
    for shard in range(shards):
        counts, before = mixing.drawn(np.array(quotas), shards, shard, 5)
        assert (before == held).all() and (counts >= 0).all()
        assert counts.sum() == sum(quotas) * (shard + 1) // shards - sum(quotas) * shard // shards
        held += counts
    assert held.tolist() == quotas


def test_the_query_takes_each_target_to_the_word(spark):
    got = queries.op3_source_mix(spark, SMALL).collect()
    docs = {r.doc_id: r for r in queries.table(spark, SMALL, "documents").collect()}
    assert len(got) == len(docs)
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        sizes[docs[r.doc_id].source] += r["size"]
        taken[docs[r.doc_id].source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    expected = {s.name: s for s in mixing.targets(dict(sizes))}
    for r in got:
        s = expected[docs[r.doc_id].source]
        assert (r.source_size, r.target) == (s.size, s.target)
    assert {name: abs(taken[name] - s.target) <= 0.5 for name, s in expected.items()} == dict.fromkeys(expected, True)
    assert sorted(got) == sorted(queries.op3_source_mix(spark, SMALL).collect())


ROWS = [
    (1, "a b c", "en", "s", 5, "own"), (None, "d  e\nf", None, "s", 6, None), (2, "", "en", None, 0, ""), (3, None, "en", "t", None, ""),
    (4, " x " * 700, "en", "t", 2100, ""), (5, "same same", "en", "t", 9, ""), (5, "same same", "en", "t", 9, ""), (6, "lone", "en", "u", 4, ""),
]


def test_mixed_documents_hold_what_the_mix_takes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long, begin string")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r.source] += len((r.text or "").split())
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len((r[1] or "").split())
    assert {s.name: s.words for s in mixing.targets(dict(sizes))} == {name: words[name] for name in sizes}
    assert mixed.filter("coalesce(text, '') = ''").count() == 2
    whole = {r[1] for r in ROWS}
    for r in mixed.filter("text <> ''").collect():
        assert r.text in whole or re.sub(r"\s+", " ", r.text) in " ".join((next(x[1] for x in ROWS if x[0] == r.doc_id)).split())


def test_blocks_are_joined_by_index(spark):
    docs = spark.createDataFrame([(i, f"s{i % 2}", 37 * i) for i in range(60)], "doc_id long, source string, n long")
    placed, sources = mixing.place(docs, F.col("n"))
    rows = mixing.mix(placed, sources, per_shard=8).collect()
    slots = Counter((r.shard, r.slot) for r in {(r.shard, r.slot, r.block, r["pass"], r.source_index): r for r in rows}.values())
    assert set(slots.values()) == {1}
    once = Counter((r.source_index, r["pass"], r.block, r.at) for r in rows)
    assert set(once.values()) == {1}  # within a pass no block comes twice
    full = [k for k, v in Counter(r.shard for r in {(r.shard, r.slot): r for r in rows}.values()).items() if abs(v - 8) <= 1]
    assert len(full) == len({r.shard for r in rows})


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert mixing.mixed_documents(none).count() == 0
