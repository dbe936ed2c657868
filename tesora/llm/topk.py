"""Operator 10: exact top-k inner products by norm-bucketed retrieval.

Vectors are sorted by length and cut into buckets of ``BUCKET`` vectors. The
longest vectors answer first: a query's k-th score there is a threshold that its
final k-th score cannot fall below. Every other bucket is then met with the
local cosine threshold ``theta / (|q| * longest of the bucket)``:

* above 1, no vector of the bucket can reach theta: the bucket is passed over;
* high, coordinates prune: on the query's largest coordinates, a vector that reaches theta
  must lie within an interval that follows from the threshold;
* low, lengths prune: only the bucket's vectors of length ``theta / |q|`` or more can reach it.

What is left is verified by exact products. Queries travel in packs; a task
sees one bucket with a bounded number of packs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesora.llm.common import ship, stored

BUCKET = 4096
PACK = 128  # queries in a pack
PACKS = 32  # packs that meet a bucket in one task
COORDINATES = 3
BY_COORDINATE = 0.6  # local thresholds from here on prune by coordinates
SEED = BUCKET  # vectors that give the first thresholds

_FOUND = "query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, column: str) -> DataFrame:
    """vec_id and v, the components as floor(256 * x). A vector that is null, empty, or has null or non-finite components is left
    out, and so is one without vec_id."""
    x = F.col(column)
    sound = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * 256)).alias("v")
    )


def buckets(vectors: DataFrame, parts: int) -> DataFrame:
    """(dim, bucket, longest, ids, v): vectors of one dimension in order of falling length, BUCKET to a row."""

    def pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        dim = part = at = -1

        def out() -> pa.RecordBatch:
            nonlocal at, held
            at += 1
            v = np.stack([x for _, x in held])
            longest = float(np.sqrt(np.square(v.astype(float)).sum(axis=1)).max())
            row = [dim, (part << 32) + at, longest, np.array([i for i, _ in held], "<i8").tobytes(), v.astype("<i8").tobytes()]
            held = []
            types = [pa.int32(), pa.int64(), pa.float64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["dim", "bucket", "longest", "ids", "v"])

        for batch in source:
            v = batch.column("v")
            flat, ends = np.asarray(v.flatten()), np.cumsum([0, *np.diff(v.offsets.to_numpy())])
            for i, (name, d, p) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("dim").to_pylist(), batch.column("part").to_pylist())):
                if held and (d != dim or len(held) == BUCKET):
                    yield out()
                dim, part = d, p
                held.append((name, flat[ends[i] : ends[i + 1]]))
        if held:
            yield out()

    ship(vectors.sparkSession)
    length = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e)
    ordered = (
        vectors.select("vec_id", "v", F.size("v").alias("dim"), length.alias("length"))
        .repartitionByRange(parts, "dim", F.desc("length"), "vec_id")
        .sortWithinPartitions("dim", F.desc("length"), "vec_id")
        .select("vec_id", "v", "dim", F.spark_partition_id().alias("part"))
    )
    return ordered.mapInArrow(pack, "dim int, bucket long, longest double, ids binary, v binary")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= edge)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_bucket(ids: np.ndarray, v: np.ndarray, queries: list[tuple[int, np.ndarray, int | None]], k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of each query's k best of a bucket that reach its threshold; lengths fall along the bucket."""
    real = v.astype(float)
    lengths = np.sqrt(np.square(real).sum(axis=1))
    unit = real / np.maximum(lengths, 1e-300)[:, None]
    columns = np.ascontiguousarray(unit.T)
    found: list[tuple[int, int, int]] = []
    # Products of whole numbers are exact in floating point as long as they stay below 2**53.
    biggest = float(np.abs(real).max(initial=0))
    for name, q, theta in queries:
        norm = float(np.sqrt(np.square(q.astype(float)).sum()))
        chosen = None
        if theta is not None and theta > 0:
            local = theta / max(norm * lengths[0], 1e-300)
            if local > 1 + 1e-9:
                continue
            if local >= BY_COORDINATE:
                t, chosen = min(local, 1.0), np.ones(len(v), bool)
                direction = q / norm
                for f in np.argsort(-np.abs(direction), kind="stable")[:COORDINATES]:
                    middle, reach = t * direction[f], np.sqrt(max((1 - t * t) * (1 - direction[f] ** 2), 0.0)) + 1e-9
                    # Below the least cosine t lie only vectors whose coordinate is outside, on the far side from the query.
                    chosen &= columns[f] >= middle - reach if direction[f] > 0 else columns[f] <= middle + reach
                chosen = np.flatnonzero(chosen)
            else:
                chosen = np.arange(np.searchsorted(-lengths, -(theta / norm) * (1 - 1e-9), side="right"))
        some, which = (v, ids) if chosen is None else (v[chosen], ids[chosen])
        if biggest * float(np.abs(q).max(initial=0)) * v.shape[1] < 2.0**53:
            scores = (some.astype(float) @ q.astype(float)).astype(np.int64)
        else:
            scores = some @ q
        keep = which != name if theta is None else (which != name) & (scores >= theta)
        which, scores = which[keep], scores[keep]
        for i in best(which, scores, k):
            found.append((name, int(which[i]), int(scores[i])))
    return found


def _search(buckets: DataFrame, packs: DataFrame, k: int) -> DataFrame:
    """Each bucket with every group of packs of its dimension: the stated queries against all vectors, in blocks."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        packs = right.column("queries").to_pylist()
        for row in left.to_pylist():
            ids = np.frombuffer(row["ids"], "<i8")
            v = np.frombuffer(row["v"], "<i8").reshape(len(ids), -1)
            queries = [(q["vec_id"], np.array(q["v"], np.int64), q["theta"]) for pack in packs for q in pack]
            found += search_bucket(ids, v, queries, k)
        columns = list(zip(*found)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    groups = packs.select("dim", F.col("group").alias("met")).distinct()
    left = buckets.join(groups, "dim").select("bucket", "met", "ids", "v")
    right = packs.join(buckets.select("dim", F.col("bucket").alias("block")), "dim").select("block", "group", "queries")
    return left.groupBy("bucket", "met").cogroup(right.groupBy("block", "group")).applyInArrow(meet, _FOUND)


def _packs(queries: DataFrame) -> DataFrame:
    """(dim, group, queries): queries of one dimension, about PACK to a row and PACKS rows to a group."""
    n = queries.groupBy("dim").agg(F.count("*").alias("n")).withColumn("packs", F.ceil(F.col("n") / PACK))
    dealt = queries.join(F.broadcast(n), "dim").withColumn("pack", F.pmod(F.xxhash64("vec_id"), F.col("packs")))  # a row for each dimension
    return dealt.groupBy("dim", "pack").agg(F.collect_list(F.struct("vec_id", "v", "theta")).alias("queries")).select(
        "dim", (F.col("pack") / PACKS).cast("long").alias("group"), "queries"
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best vectors by inner product of floor(256 * x), ties to the smaller vec_id.

    A query is a vec_id for which ``is_query`` holds; of several rows with it, the least vector asks. Rows with its vec_id are
    not its results. Only vectors of one dimension meet. Products have to fit 64 bits. Unsound vectors (see
    ``whole_vectors``) take no part; no vectors, or no others than the query: no rows.
    """
    spark = vectors.sparkSession
    whole = stored(whole_vectors(vectors, column), "vectors")
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-whole.count() // BUCKET)))
    blocks = stored(buckets(whole, parts), "buckets")
    asked = whole.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    head = blocks.groupBy("dim").agg(F.min("bucket").alias("bucket"))
    first = blocks.join(head, ["dim", "bucket"], "left_semi")
    seeds = stored(_search(first, _packs(asked.withColumn("theta", F.lit(None).cast("long"))), k), "seeds")
    # A query that has k scores already cannot end with a k-th score below the least of them.
    theta = seeds.groupBy("query_id").agg(F.min("score").alias("theta"), F.count("*").alias("n")).filter(F.col("n") == k)
    known = asked.join(theta.select(F.col("query_id").alias("vec_id"), "theta"), "vec_id", "left")
    rest = _search(blocks.join(head, ["dim", "bucket"], "left_anti"), _packs(known), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = seeds.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
