"""Operator 8: consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

A key's hash is a point on a ring that is quantised into ``CELLS`` cells. Every
shard owns the arcs that end in its virtual nodes. A shard takes at most its
capacity; keys that find their shard full go on clockwise to the next virtual
node whose shard has room.

The walk around the ring needs only how many rows each arc holds, so the driver
sees one count per arc (shards times virtual nodes, whatever the input's size)
and answers with intervals of ranks: rows ``lo <= rank < hi`` of an arc go to one
shard and begin at one slot. A row's rank in its arc is the count of the arc's
earlier cells plus its rank within its cell; no window is wider than a cell.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 16
CELLS = 1 << CELL_BITS


def virtual_nodes(shards: int, per_shard: int) -> list[tuple[int, int]]:
    """(cell, shard) clockwise. A shard's points do not depend on the number of shards; the lower shard keeps a shared cell."""
    owner: dict[int, int] = {}
    for shard in range(shards):
        for node in range(per_shard):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            owner.setdefault(int.from_bytes(digest, "big") % CELLS, shard)
    return sorted(owner.items())


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may hold. Without slack they add up to the input, so counts differ by one at most."""
    if slack > 0:
        return [int(-(-rows * (1 + slack) // shards))] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def walk(arcs: Sequence[int], loads: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, lo, hi, shard, first slot): first every arc fills its owner, then what is left goes on clockwise."""
    room, used, placed, left = list(room), [0] * len(room), [], []

    def give(arc: int, lo: int, hi: int, shard: int) -> int:
        take = min(hi - lo, room[shard])
        if take:
            placed.append((arc, lo, lo + take, shard, used[shard]))
            room[shard] -= take
            used[shard] += take
        return lo + take

    for arc, shard in enumerate(arcs):
        n = loads.get(arc, 0)
        done = give(arc, 0, n, shard)
        if done < n:
            left.append((arc, done, n))
    for arc, lo, hi in left:
        step = arc
        while lo < hi:
            step = (step + 1) % len(arcs)
            lo = give(arc, lo, hi, arcs[step])
    return placed


def assign(
    df: DataFrame,
    shards: int,
    key: Sequence[str] = ("doc_id", "text"),
    per_shard: int = 64,
    slack: float = 0.0,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Every row with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``key`` places a row on the ring; ties are ordered by ``spread``. Nulls are values like others.
    Rows equal in all of key and spread are interchangeable. An empty input gives an empty result. Input
    columns named ``shard`` or ``slot`` are replaced.
    """
    spark = df.sparkSession
    kept = [name for name in df.columns if name not in ("shard", "slot")]
    point = F.xxhash64(*[F.col(f"`{name}`") for name in key])
    cell = F.shiftrightunsigned(point, 64 - CELL_BITS).cast("int")
    nodes = virtual_nodes(shards, per_shard)
    points = [at for at, _ in nodes]
    # The arc that ends in the last node also holds the cells behind it, up to the first node.
    starts = [0] + [at + 1 for at in points]
    spans = [(starts[i], points[i], i) for i in range(len(nodes))] + ([(points[-1] + 1, CELLS - 1, 0)] if points[-1] < CELLS - 1 else [])
    ring = spark.createDataFrame(spans, "first int, last int, arc int").select(
        F.explode(F.sequence("first", "last")).alias("cell"), "arc"
    )

    counts = df.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).join(F.broadcast(ring), "cell")
    # A cell before the first node belongs to arc 0 as do those behind the last: the latter come first on the ring.
    clockwise = (F.col("arc") == 0) & (F.col("cell") <= points[0])
    before = Window.partitionBy("arc").orderBy(clockwise.cast("int"), "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("cell", "arc", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    loads = {row.arc: row.n for row in cells.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    plan = walk([shard for _, shard in nodes], loads, capacities(sum(loads.values()), shards, slack))
    intervals = spark.createDataFrame(plan, "arc int, lo long, hi long, shard int, base long")

    rows = df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"), point.alias("point"), cell.alias("cell"))
    order = ["point", *[F.col("row").getField(name) for name in (*key, *spread)]]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("cell").orderBy(*order)) - 1)
    # At most CELLS narrow rows, and at most an interval for each virtual node and shard: both sides are bounded.
    in_arc = ranked.join(F.broadcast(cells.select("cell", "arc", "ahead")), "cell").withColumn("rank", F.col("rank") + F.col("ahead"))
    return in_arc.join(
        F.broadcast(intervals),
        (in_arc["arc"] == intervals["arc"]) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")),
    ).select(*[F.col("row").getField(name).alias(name) for name in kept], "shard", (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))


def home_of(nodes: list[tuple[int, int]], cell: int) -> int:
    """The owner of a cell before loads are bounded."""
    return nodes[bisect_left([at for at, _ in nodes], cell) % len(nodes)][1]
