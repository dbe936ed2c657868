"""Operator 10 against brute force and its SQL."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import connect, differences
from tesora.llm import queries, topk


def brute(rows, k, every=1):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q in sorted({i for i, _ in sound if i % every == 0}):
        asks = min(v for i, v in sound if i == q)
        scores = sorted((-sum(a * b for a, b in zip(asks, v)), i) for i, v in sound if i != q and len(v) == len(asks))
        found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return found


@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_a_bucket_loses_nothing_that_reaches_the_threshold(seed, n, d):
    rng = np.random.default_rng(seed)
    v = rng.integers(-40, 40, (n, d))
    v = v[np.argsort(-np.square(v).sum(axis=1), kind="stable")]
    ids = np.arange(n)
    q = rng.integers(-40, 40, d)
    for theta in (None, int(np.sort(v @ q)[-min(n, 3)]), 10**6):
        got = topk.search_bucket(ids, v, [(-1, q, theta)], 3)
        expected = sorted((-int(s), int(i)) for i, s in zip(ids, v @ q) if theta is None or s >= theta)[:3]
        assert got == [(-1, i, -s) for s, i in expected]


@pytest.mark.parametrize("bucket", [3, 4096])
def test_odd_vectors(spark, monkeypatch, bucket):
    monkeypatch.setattr(topk, "BUCKET", bucket)
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(0, 1, 4) * (1 + i % 5)).tolist()) for i in range(40)] + [(100 + i, [0.5, 0.5, 0.0, 0.0]) for i in range(15)]
    rows += [(200, None), (201, []), (202, [1.0, None, 2.0, 0.0]), (203, [float("nan"), 1.0, 1.0, 1.0]), (204, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(205, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (206, [0.0] * 4), (7, rows[7][1]), (300, [1e6, 1e6, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = sorted(map(tuple, topk.top_k(df, F.lit(True), 3).collect()))
    assert got == brute(rows, 3)
    assert topk.top_k(df.limit(0), F.lit(True), 3).count() == 0


def test_the_query_equals_its_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(queries.op10_norm_buckets(spark, "/root/testdata/sf0.001"), con, queries.NEAREST) == []
