"""The corpus pipeline: five stages from raw documents to shards, each by one operator of ``tesora.llm``.

A stage takes (spark, docs, sf_dir) and returns the columns of documents; the last one adds shard and slot. Every stage
works on all rows that its predecessor kept, and is written as Parquet and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tesora.llm import decontaminate, mixing, near_dup, quality, sharding
from tesora.llm.common import stored

SHARDS = 24


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant, learnt from ``labels``, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest doc_id."""
    return near_dup.drop_copies(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes: a row for each pass that takes words of a document."""
    return mixing.mixed_documents(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs, SHARDS)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("decontamination", no_benchmark),
    ("source_mix", to_weights),
    ("shards", into_shards),
]

# A classifier's scores and MinHash classes have no SQL; tests/llm/test_pipeline.py compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
