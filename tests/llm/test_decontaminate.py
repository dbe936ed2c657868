"""Operator 6 against a plain comparison of every alignment."""

from __future__ import annotations

import math
import random
import string

from tesora.llm import decontaminate, queries

DATA = "/root/testdata/sf0.001"


def plain_tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)}).translate({ord(c): None for c in string.punctuation})
    return lower.encode().split()


def brute(docs, items, least=13, matched=10):
    """Every alignment, every window; no seeds."""
    found = set()
    for d, text in docs:
        for i, item in items:
            a, b = plain_tokens(text), plain_tokens(item)
            if not b:
                continue
            size = min(least, len(b))
            need = len(b) if len(b) < 6 else math.ceil(matched * size / least)
            for offset in range(1 - len(b), len(a)):
                same = [a[offset + k] == b[k] for k in range(len(b)) if 0 <= offset + k < len(a)]
                if any(sum(same[k : k + size]) >= need for k in range(len(same) - size + 1)):
                    found.add((d, i))
                    break
    return found


def test_passages_with_substitutions(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(3, 40)))) for i in range(25)] + [(90, None), (91, ""), (92, "one two"), (93, "a b c d e f"), (4, None)]
    docs = []
    for d in range(120):
        text = rng.choices(words, k=rng.randrange(0, 60))
        if d % 2:
            passage = items[d % 25][1].split()
            for _ in range(rng.randrange(5)):
                passage[rng.randrange(len(passage))] = rng.choice(words)
            at = rng.randrange(len(text) + 1)
            text[at:at] = [w.upper() + rng.choice(["", ",", "!"]) for w in passage[rng.randrange(4) :]]
        docs.append((d, "\n".join(text)))
    docs += [(500, None), (501, ""), (502, "x " * 50_000 + items[3][1]), (None, "A, b. C (d) e f"), (503, items[3][1]), (503, items[3][1])]
    spark_docs = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, item_id string")
    spark_items = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(spark_docs, spark_items).collect()
    expected = brute([x for x in docs if x[0] != 502], items)
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id != 502} == expected and len(expected) > 30
    assert (502, 3) in {(r.doc_id, r.item_id) for r in got}
    kept = decontaminate.clean(spark_docs, spark_items)
    assert kept.columns == spark_docs.columns
    leaky = {d for d, _ in expected} | {r.doc_id for r in got}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in leaky)
    assert decontaminate.overlaps(spark_docs.limit(0), spark_items).count() == 0
    assert decontaminate.clean(spark_docs, spark_items.limit(0)).count() == len(docs)


def test_the_query_finds_planted_items_and_nothing_else(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, DATA, "benchmark").collect()]
    whole = {(d, i) for d, text in docs for i, item in items if item in (text or "")}
    got = {(r.doc_id, r.item_id) for r in queries.op6_spaced_seeds(spark, DATA).collect()}
    assert whole and got == whole


def test_the_query_equals_every_alignment_on_real_tables(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, DATA, "documents").collect()]
    items = [(r.item_id, r.text) for r in queries.table(spark, DATA, "benchmark").collect()]
    rng = random.Random(3)
    planted = []
    for k in range(60):
        own = plain_tokens(rng.choice(items)[1])
        own = [w.decode() for w in own]
        for place in rng.sample(range(len(own)), min(len(own), rng.randrange(6))):
            own[place] = f"changed{k}"
        planted.append((10**6 + k, "before it " + " ".join(own) + " after it"))
    some = docs[:60] + planted
    df = spark.createDataFrame(some, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, queries.table(spark, DATA, "benchmark")).collect()}
    assert got == brute(some, items) and len(got) > 20


def test_one_repeated_word_in_item_and_document_gives_no_pairs(spark):
    docs = spark.createDataFrame([(1, "x " * 20_000), (2, "y " + "x " * 30), (3, "x " * 11), (4, "x " * 5_000 + "y")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "x " * 400), (2, "x " * 300 + "y")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.length, r.matches) for r in decontaminate.overlaps(docs, items).collect()}
    assert got[1, 1] == (0, 400, 400) and got[2, 1] == (1, 30, 30) and got[4, 2] == (4700, 301, 301) and not any(d == 3 for d, _ in got)
    seeds = decontaminate.item_seeds(items).drop("span").cache()
    keyed = docs.withColumn("row_key", docs["doc_id"]).select("row_key", "text")
    hits = decontaminate._hits(keyed, list(decontaminate.MASKS), decontaminate.bitmap(seeds)).cache()
    pairs = hits.join(seeds.filter("first"), "seed").count() + hits.filter("first").join(seeds.filter("NOT first"), "seed").count()
    every = {tuple(r) for r in hits.drop("first").join(seeds.drop("first"), "seed").selectExpr("row_key", "item_id", "at - pos").distinct().collect()}
    assert {tuple(r) for r in decontaminate.alignments(hits, seeds).collect()} == every and pairs < 20 * len(every)
