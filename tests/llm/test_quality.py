"""Operator 4: the discriminant against densities written out, and its held-out accuracy."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from tesora.llm import quality, queries

DATA = "/root/testdata/sf0.01"


def test_scores_are_those_of_two_normal_densities():
    rng = np.random.default_rng(3)
    d = len(quality.FEATURES)
    groups = [rng.normal(0, 1, (80, d)) @ rng.normal(0, 1, (d, d)), rng.normal(0.5, 1, (200, d))]
    n = np.array([80.0, 200.0])
    model = quality.fit(n, np.array([g.sum(0) for g in groups]), np.array([g.T @ g for g in groups]), pooled=0.4, ridge=0.05)
    every = np.concatenate(groups)
    z = [(g - every.mean(0)) / every.std(0) for g in groups]
    within = sum((g - g.mean(0)).T @ (g - g.mean(0)) for g in z) / 280
    log = []
    for k in (0, 1):
        s = 0.6 * np.cov(z[k].T) + 0.4 * within
        s = 0.95 * s + 0.05 * np.trace(s) / d * np.eye(d)
        gap = (every - every.mean(0)) / every.std(0) - z[k].mean(0)
        log.append(np.log((n[k] + 0.5) / 281) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", gap, np.linalg.inv(s), gap))
    assert np.allclose(model.scores(every), 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50))), atol=1e-7)


def test_held_out_documents_are_told_apart(spark):
    labels = {r.doc_id: r.quality for r in queries.table(spark, DATA, "labels").collect()}
    got = queries.op4_quality_discriminant(spark, DATA).collect()
    assert len(got) == queries.table(spark, DATA, "documents").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    right = [r.predicted == labels[r.doc_id] for r in got if r.held_out and r.doc_id in labels]
    assert len(right) > 50 and np.mean(right) > 0.97
    assert sorted(got) == sorted(queries.op4_quality_discriminant(spark, DATA).collect())


@pytest.mark.parametrize("marked", [[], [(1, 1)], [(1, 1), (2, None), (99, 0), (None, 1)]])
def test_odd_documents_and_labels(spark, marked):
    rows = [(1, "Plain words.", "a"), (2, None, None), (3, "", ""), (None, "!!! ### 123", "x"), (4, "long " * 50_000, ""), (4, "long " * 50_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(marked, "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert marked or {r.score for r in got} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
