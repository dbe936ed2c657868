"""Operator 11: counts against plain code, trees against a walk of each node, directions kept, held-out accuracy."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesora.llm import boosted_rules, queries

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text: str | None) -> list[int]:
    text = text or ""
    words = WORD.findall(text)
    at = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {j for i in range(len(words) - 2) if at[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)]


@given(st.text(st.sampled_from("ab éß\n\t\x0b#|<.😀"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts(text):
    assert boosted_rules.statistics(text.encode())[0] == counts(text)


def test_base_columns_of_all_documents(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, DATA, "documents").collect()}
    got = queries.op11_boosted_rules(spark, DATA).collect()
    assert len(got) == len(texts)
    for r in got:
        want = counts(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in queries.table(spark, DATA, "labels").collect()}
    unseen = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in labels and not r.base_failed]
    assert len(unseen) > 40 and np.mean([r.kept == labels[r.doc_id] for r in unseen]) > 0.95
    assert sorted(got) == sorted(queries.op11_boosted_rules(spark, DATA).collect())


def walk(trees: boosted_rules.Trees, row: np.ndarray) -> float:
    total = trees.prior
    for at in trees.roots:
        while trees.left[at] != at:
            at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
        total += trees.value[at]
    return 1 / (1 + np.exp(-total))


@pytest.mark.parametrize("seed", range(4))
def test_scores_are_walks_and_keep_their_directions(seed):
    rng = np.random.default_rng(seed)
    names = ("up", "down", "free")
    x = np.round(rng.normal(0, 1, (400, 3)), 1)
    y = (np.sin(2 * x[:, 0]) + np.cos(3 * x[:, 1]) + x[:, 2] + rng.normal(0, 0.5, 400) > 0).astype(float)
    trees = boosted_rules.fit(x, y, rounds=25, depth=4, monotone={"up": 1, "down": -1}, names=names)
    assert np.allclose(trees.scores(x), [walk(trees, row) for row in x])
    grid = np.linspace(-3, 3, 61)
    for row in x[:50]:
        for f, sign in ((0, 1), (1, -1)):
            moved = np.tile(row, (len(grid), 1))
            moved[:, f] = grid
            assert (sign * np.diff(trees.scores(moved)) >= -1e-12).all()
    free = boosted_rules.fit(x, y, rounds=25, depth=4, monotone={}, names=names)
    loss = lambda t: -np.mean(y * np.log(t.scores(x)) + (1 - y) * np.log(1 - t.scores(x)))
    assert loss(free) < loss(trees) < 0.69


@pytest.mark.parametrize("marked", [[], [(1, 1)], [(1, 1), (2, None), (99, 0), (None, 1)], [(1, 1), (7, 0), (7, 0)]])
def test_odd_documents_and_labels(spark, marked):
    good, loud = "Plain words make sense here. " * 3 + " ".join(f"word{i}" for i in range(80)), "### " * 30 + " ".join(f"#{i}" for i in range(80))
    rows = [(1, good, "a"), (2, None, None), (3, "", ""), (None, good, "x"), (7, loud, "z"), (4, "long " * 100_000, ""), (4, "long " * 100_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(marked, "doc_id long, quality int")
    got = boosted_rules.judge(docs, labels).collect()
    assert len(got) == 7
    by = {r.doc_id: r for r in got}
    assert by[2].base_failed and by[3].base_failed and not by[3].kept and by[2].n_words == 0
    assert by[4].base_failed and by[4].n_repeat_words == 100_000
    assert by[1].kept == by[None].kept and by[1].score == by[None].score
    assert by[1].kept
    assert boosted_rules.judge(docs.limit(0), labels).count() == 0


def test_the_sample_bound_holds(spark):
    docs = queries.table(spark, DATA, "documents")
    counted, labels = boosted_rules.count(docs), queries.table(spark, DATA, "labels")
    few = boosted_rules.learn(counted, labels, sample=30)
    assert few.prior == boosted_rules.learn(counted.repartition(7), labels, sample=30).prior
    assert few.prior != boosted_rules.learn(counted, labels).prior
