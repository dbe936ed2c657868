from __future__ import annotations

import re

from pyspark.sql import functions as F

from tesora.operators import skew
from tesora.operators.skew import key_words, mark_known, salted_lookup

# Small thresholds, so that a small table shows what a large one would do.
SKEW_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def facts(spark, n=30_000):
    """One third of all rows under one key, some under null, some unknown."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 997)
    return spark.range(n).repartition(8).select("id", key.cast("bigint").alias("k"))


def test_same_rows_as_a_plain_join(spark):
    lookup = spark.range(500).select(F.col("id").alias("k"), F.lit(True).alias("known"))
    left = facts(spark)
    salted = salted_lookup(left, lookup, ["k"], ["id"], 8).select("id", "k", "known")
    plain = left.join(lookup, "k", "left").select("id", "k", "known")
    assert salted.count() == left.count()
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()
    for how in ("left_semi", "left_anti"):
        salted = salted_lookup(left, lookup.select("k"), ["k"], ["id"], 8, how=how).select("id", "k")
        plain = left.join(lookup, "k", how).select("id", "k")
        assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_hot_key_is_spread_and_split(spark):
    previous = {key: spark.conf.get(key, None) for key in SKEW_CONF}
    for key, value in SKEW_CONF.items():
        spark.conf.set(key, value)
    try:
        lookup = spark.range(500).select(F.col("id").alias("k")).distinct().withColumn("known", F.lit(True))
        joined = salted_lookup(facts(spark), lookup, ["k"], ["id"], 4)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        joined.count()
        df = joined.withColumn("p", F.spark_partition_id())
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in previous.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert max(sizes) < 30_000 / 3 / 2
    assert re.search(r"SortMergeJoin\(skew=true\)", plan)


def test_a_lookup_that_fits_only_before_its_repetition_is_merged(spark):
    """Below the limit by itself, above it eight times over: shuffled, with the rows of a plain join."""
    lookup = spark.range(40_000).select(F.col("id").alias("k"))
    left = facts(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(40_000 * 8 * 3))
    try:
        joined = salted_lookup(left, lookup, ["k"], ["id"], 8, how="left_semi")
        small = salted_lookup(left, spark.range(50).select(F.col("id").alias("k")), ["k"], ["id"], 8, how="left_semi")
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        joined.collect()
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == left.join(lookup, "k", "left_semi").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_keys_as_words_know_the_same_rows_and_shuffle_no_fact(spark, monkeypatch):
    """Numbers below zero, padded, long, bare and foreign codes: a word never stands for a key that the set lacks."""
    codes = ["P1", "P01", "P001", "P10", "P", "", "1", "01", "é7", "P-3", "9" * 18, "9" * 19, "9" * 20, "P" + "0" * 18, "P" + "0" * 19, "P63", "P64", None]
    texts = spark.createDataFrame([(i, c) for i, c in enumerate(codes * 2)], "id long, k string")
    numbers = spark.createDataFrame([(i, n) for i, n in enumerate([-65, -64, -63, -1, 0, 1, 63, 64, 2**63 - 1, -(2**63), None] * 2)], "id long, k long")
    for left in (texts, numbers):
        for part in (0, 1, 2):
            held = left.where(F.col("k").isNotNull() & (F.col("id") % 3 == part)).select("k").distinct()
            words = key_words(held, "k")
            marked = mark_known(left, held, words, "k", "known", ["id"], 8)
            plain = left.join(held.withColumn("known", F.lit(True)), "k", "left").select("id", "k", "known")
            assert marked.columns == ["id", "k", "known"]
            assert marked.exceptAll(plain).isEmpty() and plain.exceptAll(marked).isEmpty()
    dense = spark.range(64_000).select(F.concat(F.lit("P"), "id").alias("k"))
    assert key_words(dense, "k").count() == 1000
    monkeypatch.setattr(skew, "MAX_WORDS", 999)
    assert key_words(dense, "k") is None
    shuffled = mark_known(texts, dense, None, "k", "known", ["id"], 8)
    assert shuffled.where("known").count() == 2 * 4  # P1, P10, P63, P64
