"""Operator 6: planted items with changed words are all found, whatever the rule's own arithmetic says of them."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from tesora.llm import decontaminate


def test_masks_hit_any_three_changes_of_thirteen():
    for changed in combinations(range(13), 3):
        assert any(all(k + p not in changed for p in m) for m in decontaminate.MASKS for k in range(13 - m[-1])), changed


def test_windows_of_ten_in_thirteen():
    same = np.ones(13, bool)
    same[[0, 5, 12]] = False
    assert decontaminate.windows(same, 13, 13, 10) == (0, 13, 10)
    same[7] = False
    assert decontaminate.windows(same, 13, 13, 10) == (0, 0, 0)
    assert decontaminate.windows(np.array([0] * 9 + [1] * 20 + [0] * 9, bool), 38, 13, 10) == (9, 29, 20)


def test_planted_items_with_substitutions_are_found(spark):
    rng = random.Random(11)
    fresh = iter(range(10**6))
    word = lambda: f"u{next(fresh)}"
    items, docs, expected = [], [], set()
    allowed = {1: 0, 2: 0, 3: 0, 5: 0, 6: 1, 8: 1, 9: 2, 12: 2, 13: 3, 16: 3, 20: 4, 40: 6}
    for n, most in allowed.items():
        items.append((n, " ".join(word() for _ in range(n))))
        for changes in range(most + 2):
            if n >= 16 and changes > 3:
                # spread, so that some window of 13 holds three of them at most
                spots = list(range(0, n, 5))[:changes]
            else:
                spots = rng.sample(range(min(n, 13)), min(changes, n)) if changes <= most else list(range(0, n, 2))
            passage = items[-1][1].split()
            for k in spots:
                passage[k] = word()
            name = len(docs)
            docs.append((name, " ".join([word() for _ in range(7)] + passage + [word() for _ in range(5)])))
            if changes <= most:
                expected.add((name, n))
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.overlaps(docs_df, items_df).collect()}
    wanted = expected | {key for key in got if key[1] >= 16}
    assert expected <= set(got) and set(got) == wanted
    kept = {r.doc_id for r in decontaminate.clean(docs_df, items_df).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}
    for (d, i), r in got.items():
        own, item = (t.split() for t in (docs[d][1], dict(items)[i]))
        assert r.matches <= r.length and own[r.start : r.start + r.length] and len(item) >= r.length
