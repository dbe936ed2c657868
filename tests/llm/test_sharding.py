"""Operator 8 against a plain walk of the ring, and its laws."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesora.llm import queries, sharding

SMALL = "/root/testdata/sf0.001"


@given(st.integers(1, 9), st.integers(1, 6), st.lists(st.integers(0, 40), min_size=1, max_size=60), st.sampled_from([0.0, 0.1]))
@settings(max_examples=150, deadline=None)
def test_walk_places_every_rank_once_within_capacity(shards, per_shard, loads, slack):
    arcs = [shard for _, shard in sharding.virtual_nodes(shards, per_shard)]
    loads = {i: n for i, n in enumerate(loads) if i < len(arcs)}
    room = sharding.capacities(sum(loads.values()), shards, slack)
    placed = sharding.walk(arcs, loads, room)
    assert {(a, i) for a, lo, hi, _, _ in placed for i in range(lo, hi)} == {(a, i) for a, n in loads.items() for i in range(n)}
    held = Counter()
    for _, lo, hi, shard, base in placed:
        assert base == held[shard]
        held[shard] += hi - lo
    assert all(held[s] <= room[s] for s in range(shards))


def test_the_query_keeps_its_law(spark):
    got = queries.op8_ring_shards(spark, SMALL).collect()
    assert len(got) == 200 == len({r.doc_id for r in got})
    counts = Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts[s] for s in range(24)) <= 1
    for shard in range(24):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))
    assert got and sorted(got) == sorted(queries.op8_ring_shards(spark, SMALL).collect())


def test_rows_stay_at_home_unless_it_is_full(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "CAST(id AS string) AS text")
    placed = {r.doc_id: r.shard for r in sharding.assign(df, 6, slack=2.0).collect()}  # so much room that nothing overflows
    nodes = sharding.virtual_nodes(6, 64)
    cells = {r.doc_id: r.cell for r in df.selectExpr("doc_id", "CAST(shiftrightunsigned(xxhash64(doc_id, text), 48) AS int) AS cell").collect()}
    assert placed == {d: sharding.home_of(nodes, cell) for d, cell in cells.items()}
    more = {r.doc_id: r.shard for r in sharding.assign(df, 7, slack=2.0).collect()}
    assert {more[d] for d in placed if more[d] != placed[d]} == {6}  # with room, a new shard takes rows only into itself
    tight = {r.doc_id: r.shard for r in sharding.assign(df, 6).collect()}
    assert set(Counter(tight.values()).values()) == {500}
    assert sum(tight[d] != placed[d] for d in placed) < 1000


@pytest.mark.parametrize("n", [0, 1, 50])
def test_nulls_ties_clashes_and_few_rows(spark, n):
    rows = [(None, None, "x", 7)] * n + [(1, "", None, 8)] * n
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, cell int")
    got = sharding.assign(df, 5).collect()
    assert len(got) == 2 * n and sharding.assign(df, 5).columns == ["doc_id", "text", "cell", "shard", "slot"]
    counts = Counter(r.shard for r in got)
    assert not n or max(counts.values()) - min(counts[s] for s in range(5)) <= 1
    assert len({(r.shard, r.slot) for r in got}) == 2 * n
