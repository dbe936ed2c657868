"""Operator 12 against brute force and its SQL; border failures, ties and overlaps."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from checks.compare import connect, differences
from tesora.llm import phrases, queries

DATA = "/root/testdata/sf0.001"


def brute(rows, least=10, longest=3, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    held = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    dropped = {
        (lang, p[i : i + size]) for (lang, p), v in held.items() for size in range(2, len(p)) for i in range(len(p) - size + 1)
        if 100 * v >= inside * held[lang, p[i : i + size]]
    }
    out = []
    for (lang, p), a in held.items():
        if (lang, p) not in dropped:
            score, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    rank, result = Counter(), []
    for lang, score, a, p, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], p.decode(), -a, left, right, n[lang], -score))
    return result


def mined(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "lang string, text string")
    return sorted(tuple(r) for r in phrases.collocations(docs, bits=12, **settings).collect())


def test_the_query_equals_its_sql_and_brute_force(spark):
    assert not differences(queries.op12_toivonen_phrases(spark, DATA), connect(DATA), queries.oracle_sql()["op12_toivonen_phrases"])
    rows = [(r.lang, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    assert sorted(map(tuple, queries.op12_toivonen_phrases(spark, DATA).collect())) == sorted(brute(rows))


@pytest.mark.parametrize("sample", [0.0, 0.3, 1.0])
@pytest.mark.parametrize("longest", [3, 4])
def test_the_sample_never_changes_the_result(spark, sample, longest):
    rng = np.random.default_rng(5)
    rows = [(["en", None, "fr"][i % 3], " ".join(rng.choice(["a", "B", "cé", "d.", "e,", "\t"], 40))) for i in range(60)]
    want = sorted(brute(rows, 6, longest, top=50))
    assert want and mined(spark, rows, least=6, longest=longest, sample=sample, top=50) == want


def test_failures_of_words_pairs_and_triples_are_found(spark):
    """No proposal at all: words fail first, then their pairs; three passes."""
    rows = [("en", "x y z. " * 12 + "p q. " * 12 + "once more")]
    found = phrases.frequent(spark.createDataFrame(rows, "lang string, text string"), sample=0.0, bits=12)
    got = {r.phrase: r.n for r in found.collect() if r["size"]}
    assert got == {"x": 12, "y": 12, "z": 12, "x y": 12, "y z": 12, "x y z": 12, "p": 12, "q": 12, "p q": 12}


def test_odd_texts(spark):
    assert mined(spark, []) == []
    rows = [(None, None), ("en", ""), ("und", "a a a a a a a a a a a"), (None, "A a"), ("en", "tab\tbed\x0bx " * 10), ("en", "nul\x00 a;" * 10)] + [("de", "ist ß! ")] * 12
    assert mined(spark, rows) == sorted(brute(rows))
    clash = spark.createDataFrame([("en", "to be " * 12, 1, "x")], "lang string, text string, n long, phrase string")
    assert [r.phrase for r in phrases.collocations(clash, bits=12).collect()] == [p for _, _, p, *_ in brute([("en", "to be " * 12)])]


def test_long_texts_are_read_in_slices(monkeypatch, spark):
    monkeypatch.setattr(phrases, "SLICE", 64)
    text = "One two, three four" + " five" * 40 + "é" * 100 + " end.\n" + "solid" * 50
    numbers = phrases.Numbering()
    ids = np.concatenate(numbers.text(text.encode()))
    words = [numbers.words[i].decode(errors="replace") for i in ids if i]
    assert words == re.findall("[^ ]+", re.sub("[.,\n]", " ", text.replace("O", "o")))
    assert (ids == 0).sum() == 4
