from __future__ import annotations

import random

from conftest import rows
from pyspark.sql import functions as F

from tesora.operators import cleanse

ORDER = ("_at", "_file", "_pos")
SCHEMA = "k int, v string, _at int, _file string, _pos bigint"


def copies():
    """A hot key, ordinary keys, null keys, null order values and full copies."""
    data = [(7, f"h{i % 3}", i % 5, f"f{i % 4}", i) for i in range(400)]
    data += [(i, "x", None if i % 2 else 1, None, i) for i in range(100, 130)]
    data += [(i, "y", None, "f", i + 1000) for i in range(100, 130)]
    data += [(None, "n", 1, "f", i) for i in range(5)]
    return data


def brute_force(data):
    def rank(row):
        return [(value is not None, value if value is not None else 0) for value in (row[2],)] + [
            (row[3] is not None, row[3] or ""), (row[4] is not None, row[4])
        ]

    best = {}
    for row in data:
        if row[0] is not None and (row[0] not in best or rank(row) > rank(best[row[0]])):
            best[row[0]] = row
    kept = sorted(best.values(), key=str)
    left = list(data)
    for row in kept:
        left.remove(row)
    return kept, sorted([r for r in left if r[0] is not None], key=str)


def test_trim_takes_spaces_only_and_upper_only_named(spark):
    df = spark.createDataFrame([(" a ", "\tb ", 1)], "x string, y string, n int")
    assert rows(cleanse.standardize(df, ["x", "absent"])) == [("A", "\tb", 1)]


def test_empty_text_is_a_key(spark):
    df = spark.createDataFrame([("",), (None,)], "k string")
    held, missing = cleanse.split_null_keys(df, "k")
    assert rows(held) == [("",)] and rows(missing) == [(None,)]


def test_dedupe_against_brute_force_in_any_row_order(spark):
    data = copies()
    kept, discarded = brute_force(data)
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, SCHEMA).repartition(6)
        got_kept, got_discarded = cleanse.dedupe_latest(df, "k", ORDER)
        assert sorted(map(tuple, got_kept.collect()), key=str) == kept
        assert sorted(map(tuple, got_discarded.collect()), key=str) == discarded
        tagged = cleanse.tag_latest(df, "k", ORDER)
        assert tagged.count() == len(data)
        assert sorted(map(tuple, tagged.where("_is_latest").drop("_is_latest").collect()), key=str) == kept


def test_copies_of_a_hot_key_are_cut_on_the_map_side(spark):
    df = spark.createDataFrame(copies(), SCHEMA)
    plan = cleanse.keep_latest(df, "k", ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_tagging_ranks_nothing_and_looks_up_only_repeated_keys(spark):
    df = spark.createDataFrame(copies(), SCHEMA)
    plan = cleanse.tag_latest(df, "k", ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "_salt" in plan and "(_copies" in plan


def test_hot_copies_are_spread(spark):
    """A third of all rows under one key, every one of them tagged and none in a crowd."""
    data = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5_000).cast("int").alias("k"), F.lit("v").alias("v"),
        F.lit(1).alias("_at"), F.lit("f").alias("_file"), F.col("id").alias("_pos"),
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    previous = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tagged = cleanse.tag_latest(data, "k", ORDER)
        sizes = [r["n"] for r in tagged.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for name, value in previous.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert sum(sizes) == 30_000 and max(sizes) < 30_000 / 8 * 2
    assert tagged.where("_is_latest").count() == data.select("k").distinct().count()
    assert tagged.where("_is_latest AND k = 0").first()["_pos"] == 29_997


def test_hash_added_once(spark):
    df = cleanse.add_record_hash(spark.createDataFrame([(1, "a")], "k int, v string"))
    assert df.where(F.length("_record_hash") == 64).count() == 1


def test_a_repeated_key_is_looked_up_under_the_salts_of_its_rows_alone(spark):
    """Each of 2 000 keys has two copies: at most two lookup rows for a key, where there were eight."""
    data = spark.range(4_000).select((F.col("id") % 2_000).cast("int").alias("k"), F.lit(1).alias("_at"), F.lit("f").alias("_file"), F.col("id").alias("_pos"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    previous = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tagged = cleanse.tag_latest(data, "k", ORDER)
        plan = tagged._jdf.queryExecution().executedPlan()
        tagged.collect()
        nodes, generated = [plan], []
        while nodes:
            node = nodes.pop()
            if node.nodeName() == "Generate":
                generated.append(node.metrics().apply("numOutputRows").value())
            nodes += [node.children().apply(i) for i in range(node.children().size())]
            nodes += [node.child()] if node.nodeName().startswith("WholeStageCodegen") else []
    finally:
        for name, value in previous.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert tagged.where("_is_latest").count() == 2_000
    assert generated and max(generated) <= 4_000
