"""The pipeline's stages against plain versions, each on what its predecessor kept."""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

import corpus_pipeline
import pytest

from tesora.llm import mixing, quality, queries

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_near_dup import brute as components  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root, docs, found = tmp_path_factory.mktemp("stages"), queries.table(spark, DATA, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(f"{root}/{name}")
        out = spark.read.parquet(f"{root}/{name}")
        found.append((docs, out))
        docs = out
    return dict(zip([name for name, _ in corpus_pipeline.STAGES], found))


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_order_and_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "source_mix", "shards"]
    first = stages["quality"][0].columns
    assert all(out.columns == first for _, out in list(stages.values())[:-1])
    assert stages["shards"][1].columns == [*first, "shard", "slot"]


def test_quality_keeps_what_the_classifier_accepts(spark, stages):
    docs, out = stages["quality"]
    scored = quality.classify(docs, queries.table(spark, DATA, "labels")).collect()
    assert ids(out) == sorted(r.doc_id for r in scored if r.predicted)
    marked = {r.doc_id: r.quality for r in queries.table(spark, DATA, "labels").collect()}
    kept = set(ids(out))
    assert sum(marked[d] != (d in kept) for d in marked) <= 2


def test_one_of_each_group(stages):
    docs, out = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert ids(out) == sorted(i for i, _, _, kept in components(rows, 5, 80) if kept) and len(ids(out)) < len(rows)


def test_no_benchmark(spark, stages):
    docs, out = stages["decontamination"]
    items = [r.text for r in queries.table(spark, DATA, "benchmark").collect()]
    assert ids(out) == sorted(r.doc_id for r in docs.collect() if not any(item in r.text for item in items))


def test_mix_takes_each_target(stages):
    docs, out = stages["source_mix"]
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes, taken, of = Counter(), Counter(), {}
    for r in docs.collect():
        sizes[r.source] += size(r.text)
        of[r.doc_id] = size(r.text)
    each = Counter()
    for r in out.collect():
        taken[r.source] += size(r.text)
        each[r.doc_id] += size(r.text)
        assert r.n_chars == len(r.text)
    assert {s.name: s.words for s in mixing.targets(dict(sizes))} == dict(taken)
    assert all(each[d] <= 3 * of[d] for d in each)


def test_shards_are_even(stages):
    docs, out = stages["shards"]
    assert sorted(map(str, out.drop("shard", "slot").collect())) == sorted(map(str, docs.collect()))
    counts = Counter(r.shard for r in out.collect())
    assert max(counts.values()) - min(counts[s] for s in range(24)) <= 1


def test_odd_documents_pass_every_stage(spark, tmp_path):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (2, "word " * 40_000, "en", "s", 5, 3), (2, "word " * 40_000, "en", "s", 5, 3), (3, "!!", None, "t", 2, 4)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, shard int"
    docs = spark.createDataFrame(rows, schema)
    for each in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert set(stage(spark, each, DATA).columns) <= {*docs.columns, "slot"}
            stage(spark, each, DATA).count()
