"""Operator 3: mixing sources to target weights, in blocks of a fixed number of words.

1. ``place`` lines up each source's documents in a pseudorandom order and gives
   each the position of its first word. Sums are taken per bucket of a source
   first, then over buckets, so that no window holds a whole source.
2. A source's words are packed into blocks of ``BLOCK`` words; a document's parts
   of blocks are its pieces.
3. Output shards have a fixed number of slots. A shard's source counts are a
   multinomial draw given that all shards together take each source's quota: the
   quotas are halved over and over down to single shards, each halving being a
   draw that only its place and the seed decide. Any shard is drawn by itself.
4. A source's k-th slot takes block ``permutation(k mod blocks)`` of pass
   ``k div blocks``: a keyed pseudorandom permutation of the block indexes, another
   one for each pass. The shorter last block ends each pass, and a source's last slot is cut
   so that it takes its target to the word.
5. Slots and pieces are joined by source and block index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesora.llm.common import n_words_of, ship, stored, words_of

BLOCK = 256
SLOTS = 4096
# Documents in a bucket, about; buckets of each source follow from the number of rows.
BUCKET_ROWS = 2048
_HALVED_EVENLY = 500_000_000  # above this many slots a halving's own noise is below a ten-thousandth


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    weight: int
    target: float

    @property
    def words(self) -> int:
        return min(round(self.target), 3 * self.size)

    @property
    def blocks(self) -> int:
        return -(-self.size // BLOCK)

    @property
    def slots(self) -> int:
        passes, rest = divmod(self.words, self.size) if self.size else (0, 0)
        return passes * self.blocks + -(-rest // BLOCK)


def targets(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> list[Source]:
    """Sources by code point, null last. Targets share all sizes by weight; one that would exceed ``most`` times its
    source stops there, and the excess goes to the others by weight until none is above."""
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    total, full = sum(sizes.values()), {name: 0.0 for name in names if sizes[name] == 0}
    while True:
        free = [name for name in names if name not in full]
        rest = total - sum(full.values())
        unit = rest / sum(weight[name] for name in free) if free else 0.0
        above = [name for name in free if unit * weight[name] > most * sizes[name]]
        if not above:
            break
        full.update((name, float(most * sizes[name])) for name in above)
    return [Source(name, sizes[name], weight[name], full[name] if name in full else unit * weight[name]) for name in names]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: np.ndarray) -> np.ndarray:
    """Images of indexes below n under the permutation that a key selects: a four-round Feistel network on the next even
    power of two, walked until it falls below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low, bits = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right, k = out[walking] >> bits, out[walking] & low, key[walking]
        for turn in range(4):
            left, right = right, left ^ (_mixed(right + k + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % 2**64)) & low)
        out[walking] = (left << bits) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)


def drawn(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A shard's slots of each source, and how many of each all earlier shards have. Shards have equal numbers of slots, but for the rounding of total slots over shards."""
    lo, hi, have, before = 0, shards, quotas.astype(np.int64), np.zeros(len(quotas), np.int64)
    total = int(have.sum())
    edge = lambda i: total * i // shards
    while hi - lo > 1:
        mid = (lo + hi) // 2
        n, take = edge(hi) - edge(lo), edge(mid) - edge(lo)
        rng = np.random.Generator(np.random.Philox(key=[seed, (lo << 32) ^ hi]))
        if n > _HALVED_EVENLY:
            left = np.array([int(h) * take // n for h in have], np.int64)  # exact: products pass 64 bits
            short = np.flatnonzero(left < have)[: take - int(left.sum())]
            left[short] += 1
        else:
            left = rng.multivariate_hypergeometric(have, take, method="marginals")
        if shard < mid:
            have, hi = left, mid
        else:
            before, have, lo = before + left, have - left, mid
    return have, before


def place(docs: DataFrame, size: Column, source: str = "source") -> tuple[DataFrame, list[Source]]:
    """Rows with ``source_index``, ``size``, and ``begin``, the position of the row's first word in its source; the sources.

    Ordered by a hash of doc_id and size, so that rows with one doc_id but other texts have an order as well. What the
    driver sees is one row for each source.
    """
    sized = docs.withColumn("size", size)
    totals = sized.groupBy(source).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    sources = targets({row[source]: row["size"] for row in totals})
    buckets = max(16, -(-sum(row["n"] for row in totals) // BUCKET_ROWS))
    names = docs.sparkSession.createDataFrame([(s.name, i) for i, s in enumerate(sources)], "source_name string, source_index int")
    order = F.xxhash64("doc_id", "size")
    rows = (
        sized.join(F.broadcast(names), F.col(source).eqNullSafe(F.col("source_name")))  # a row for each source
        .drop("source_name")
        .withColumn("place_order", order)
        .withColumn("bucket", F.pmod(order, F.lit(buckets)))
    )
    sums = rows.groupBy("source_index", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source_index").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select("source_index", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("source_index", "bucket").orderBy("place_order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("begin", F.coalesce(F.sum("size").over(within), F.lit(0))).join(ahead, ["source_index", "bucket"])
    return placed.withColumn("begin", F.col("begin") + F.col("ahead")).drop("ahead", "bucket", "place_order"), sources


def pieces(placed: DataFrame) -> DataFrame:
    """(source_index, block, begin, at, lo, n): n words of the document at ``begin``, from its word ``lo`` on, stand at
    place ``at`` of a block. Documents without words have none."""
    end = F.col("begin") + F.col("size")
    block = F.explode(F.sequence(F.expr(f"begin div {BLOCK}"), F.expr(f"(begin + size - 1) div {BLOCK}"))).alias("block")
    cut = placed.filter("size > 0").select("source_index", "begin", end.alias("end"), block)
    first = F.greatest("begin", F.col("block") * BLOCK)
    return cut.select(
        "source_index",
        "block",
        "begin",
        (first - F.col("block") * BLOCK).alias("at"),
        (first - F.col("begin")).alias("lo"),
        (F.least("end", (F.col("block") + 1) * BLOCK) - first).alias("n"),
    )


def slots(spark, sources: list[Source], per_shard: int = SLOTS, seed: int = 7) -> DataFrame:
    """(shard, slot, source_index, pass, block, words) of every slot of the mix; ``words`` is below BLOCK where a source's
    last slot is cut."""
    ship(spark)
    quotas = np.array([s.slots for s in sources], np.int64)
    shards = int(-(-quotas.sum() // per_shard)) if len(quotas) else 0
    sizes = [(s.blocks, s.size // BLOCK, s.size, s.words) for s in sources]

    def fill(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for shard in batch.column("id").to_pylist():
                counts, before = drawn(quotas, shards, shard, seed)
                index = np.repeat(np.arange(len(counts)), counts)
                k = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts)])
                turn, block, words = np.zeros_like(k), np.zeros_like(k), np.full_like(k, BLOCK)
                for s in np.flatnonzero(counts):
                    blocks, whole, size, wanted = sizes[s]
                    own = index == s
                    turn[own], j = np.divmod(k[own], blocks)
                    keys = _mixed(turn[own].astype(np.uint64) + np.uint64((seed << 32) + (int(s) << 8) + 1))
                    block[own] = np.where(j < whole, permuted(np.minimum(j, max(whole - 1, 0)), max(whole, 1), keys), j)
                    words[own] = np.clip(wanted - (turn[own] * size + j * BLOCK), 0, BLOCK)
                dealt = np.random.Generator(np.random.Philox(key=[seed + 1, shard])).permutation(len(k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), shard, np.int64)), pa.array(dealt.astype(np.int64)), pa.array(index.astype(np.int32)),
                     pa.array(turn.astype(np.int32)), pa.array(block.astype(np.int64)), pa.array(words.astype(np.int64))],
                    ["shard", "slot", "source_index", "pass", "block", "words"],
                )

    return spark.range(shards).mapInArrow(fill, "shard long, slot long, source_index int, pass int, block long, words long")


def mix(placed: DataFrame, sources: list[Source], per_shard: int = SLOTS, seed: int = 7) -> DataFrame:
    """Slots joined with the pieces of their blocks: (shard, slot, source_index, pass, block, begin, at, lo, n), n cut where the slot is.

    The document is the one of ``source_index`` at ``begin``. Runs with one seed agree. No words at all: no rows.
    """
    dealt = slots(placed.sparkSession, sources, per_shard, seed).join(pieces(placed), ["source_index", "block"])
    n = F.least("n", F.col("words") - F.col("at"))
    return dealt.withColumn("n", n).filter("n > 0").drop("words")


def taken(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Placed rows with ``taken``, the words that the mix takes of each, repeats counted (0 for a row without words)."""
    used = mixed.groupBy("source_index", "begin").agg(F.sum("n").alias("taken")).withColumn("has", F.lit(True))
    rows = placed.withColumn("has", F.col("size") > 0)
    return rows.join(used, ["source_index", "begin", "has"], "left").drop("has").withColumn("taken", F.coalesce("taken", F.lit(0)))


def with_targets(df: DataFrame, sources: list[Source]) -> DataFrame:
    """Adds source_size and target by source_index: a row for each source is broadcast."""
    rows = [(i, s.size, float(s.target)) for i, s in enumerate(sources)]
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, "source_index int, source_size long, target double")), "source_index")


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents that the mix takes, with the columns of ``docs``: a row for each pass that takes words of one.

    A pass that takes all of a document's words keeps its text; one that takes part of them keeps the taken stretches in
    their order, words joined by one space. Documents without words pass once. ``n_chars`` follows the text where it is a column.
    """
    columns = docs.columns
    row = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("row")
    wrapped = docs.select(row, F.col("source").alias("source"), F.col("doc_id").alias("doc_id"), n_words_of().alias("size"))
    placed, sources = place(wrapped, F.col("size"))
    placed = stored(placed, "placed")
    used = (
        mix(placed.select("source_index", "begin", "size"), sources, seed=seed)
        .groupBy("source_index", "begin", "pass")
        .agg(F.sum("n").alias("used"), F.sort_array(F.collect_list(F.struct("lo", "n"))).alias("parts"))  # blocks of one document
    )
    joined = placed.filter("size > 0").join(used, ["source_index", "begin"])
    whole = F.col("used") == F.col("size")
    text = F.col("row.text")
    part = F.array_join(F.transform("parts", lambda p: F.array_join(F.slice(words_of(text), p["lo"].cast("int") + 1, p["n"].cast("int")), " ")), " ")
    taken_text = F.when(whole, text).otherwise(part)
    chars = {"text": taken_text} | ({"n_chars": F.when(whole, F.col("row.n_chars")).otherwise(F.char_length(part).cast("long"))} if "n_chars" in columns else {})
    some = joined.select(*[(chars[name] if name in chars else F.col("row").getField(name)).alias(name) for name in columns])
    none = placed.filter("size = 0").select(*[F.col("row").getField(name).alias(name) for name in columns])
    return some.unionByName(none)
