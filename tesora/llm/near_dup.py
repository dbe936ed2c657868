"""Operator 7: near duplicates by MinHash, and their connected components.

1. A document's set holds 64-bit hashes of its distinct word shingles. Equal sets
   are one class from here on, named by its smallest doc_id.
2. ``BANDS * ROWS`` universal hash functions give a signature of minima. Classes that agree in
   all rows of a band share a bucket.
3. Each bucket's smallest member is its hub; every member is verified against its hub on full sets.
   Links become components by alternating large-star and small-star.
4. Where members of one bucket are still in several components, they are compared
   in blocks of a bounded number of members: signatures give a pair's likely similarity, a pair is
   looked at in the first band it shares only, and what may reach the threshold is verified on full
   sets. What is written are the members of such pairs, then confirmed links, never pairs. Components are joined again.

A pair at the threshold 0.8 misses all buckets with probability 3e-6, and the
signature check of step 4 with one of 5e-6; every link is confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesora.llm.common import in_parts, ship, stored

BANDS, ROWS = 32, 5
CHUNK = 4096  # members of a bucket in a block
FEW = 1_000_000  # ids that may be broadcast; more are joined by a shuffle
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words than ``width``, the whole sequence is the only one."""
    words = text.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    taken = min(width, len(words))
    n = len(words) - taken + 1
    out = np.full(n, taken, np.uint64)
    for i in range(taken):
        out = _mixed(out + hashes[i : i + n])
    return np.unique(out)


def _family() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the hash functions h -> (a * h + b) div 2**32, from a fixed seed."""
    rng = np.random.Generator(np.random.Philox(key=20_07))
    a = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


FAMILY = _family()


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of all hash functions, in stretches so that a very long document needs no large table."""
    low = np.full(BANDS * ROWS, 2**32 - 1, np.uint64)
    a, b = FAMILY
    for i in range(0, len(hashes), 4096):
        low = np.minimum(low, ((a[:, None] * hashes[None, i : i + 4096] + b[:, None]) >> np.uint64(32)).min(axis=1))
    return low.astype("<u4")


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def _key(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, key, sig) of every row; key, a 128-bit hash of the set, and sig are null for an empty set."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(source):
            n, keys, sigs = [], [], []
            for text in _texts(batch):
                hashes = shingles(text, width)
                n.append(len(hashes))
                keys.append(_key(hashes))
                sigs.append(signature(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["doc_id", "n", "key", "sig"]
            )

    return _narrow(docs).mapInArrow(batches, "doc_id long, n long, key binary, sig binary")


def sets_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, set) of every row of the named documents. Up to FEW names are broadcast, so that no text is moved; more are joined by a shuffle."""
    named = ids.select("doc_id").distinct()
    named = F.broadcast(named) if ids.count() <= FEW else named

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in in_parts(source):
            for at in range(0, some.num_rows, 512):
                part = some.slice(at, 512)
                found = [shingles(text, width).view(np.int64) for text in _texts(part)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = np.concatenate(found) if found else np.zeros(0, np.int64)
                sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                keys = pa.array([_key(x) for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), keys, sets], ["doc_id", "key", "set"])

    return _narrow(docs).join(named, "doc_id", "left_semi").mapInArrow(batches, "doc_id long, key binary, set array<long>")


def _alike(a: Column, b: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (u, v): the smallest node it reaches.

    Large-star links each node's larger neighbours with the smallest of its neighbourhood, small-star the
    smaller ones and itself. Both keep components and end in stars. Each step's minima and edges are written tables:
    lineage stays short, and a hub's edges are joined by a plain shuffle that can be split.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "minima")

    edges = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = stored(large, "large")
        low = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        edges = stored(small.filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now


def _labelled(nodes: DataFrame, labels: DataFrame, node: str = "doc_id") -> DataFrame:
    """Adds component, a node's own id where it has none."""
    found = nodes.join(labels.withColumnRenamed("node", node), node, "left")
    return found.withColumn("component", F.coalesce("component", F.col(node)))


def _blocks(members: DataFrame, reps: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between members of one bucket that are in different components."""
    marked = stored(_labelled(members.select("band", "bucket", "doc_id"), labels), "marked")
    torn = (
        marked.groupBy("band", "bucket")
        .agg(F.count("*").alias("n"), F.min("component").alias("a"), F.max("component").alias("b"))
        .filter("a < b")
        .select("band", "bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    )
    torn = stored(torn, "torn")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    dealt = (
        marked.join(torn, ["band", "bucket"])
        .withColumn("mine", mine)
        .select("band", "bucket", "doc_id", "component", "mine", other)
        .select("band", "bucket", "doc_id", "component", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
        .join(reps.select("doc_id", "key", "sig"), "doc_id")
    )
    share = percent / 100
    least = BANDS * ROWS * (share - 4.5 * np.sqrt(share * (1 - share) / (BANDS * ROWS)))

    def block(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable[[int], np.ndarray]]:
        """Ids, components (to be changed as links are found), the rows to compare, and the rows whose signatures are near a row's."""
        band, i, j = (table.column(c)[0].as_py() for c in ("band", "i", "j"))
        ids, mine = (table.column(c).to_numpy() for c in ("doc_id", "mine"))
        comps = table.column("component").to_numpy().copy()
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(len(ids), BANDS * ROWS)

        def near(a: int) -> np.ndarray:
            right = np.flatnonzero((comps != comps[a]) & ((ids > ids[a]) if i == j else (mine == j)))
            same = sigs[right] == sigs[a]
            right, same = (x[same.sum(axis=1) >= least] for x in (right, same))
            first = same.reshape(len(right), BANDS, ROWS).all(axis=2).argmax(axis=1)  # they share this bucket's band at least
            return right[first == band]

        return ids, comps, np.arange(len(ids)) if i == j else np.flatnonzero(mine == i), near

    def likely(table: pa.Table) -> pa.Table:
        ids, _, rows, near = block(table)
        named = np.zeros(len(ids), bool)
        for a in rows.tolist():
            partners = near(a)
            if len(partners):
                named[a] = named[partners] = True
        return table.filter(pa.array(named))

    def confirm(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        once = list(dict(zip(zip(table.column("doc_id").to_pylist(), keys), range(len(keys)))).values())  # repeated rows have one set
        table = table.take(pa.array(once))
        lists = table.column("set").combine_chunks()
        flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        held = lambda x: flat[ends[x] : ends[x + 1]]
        ids, comps, rows, near = block(table)
        links = []
        for a in rows.tolist():
            for b in near(a).tolist():
                if comps[a] == comps[b]:
                    continue  # linked already through others of the block
                both = len(np.intersect1d(held(a), held(b), assume_unique=True))
                if 100 * both >= percent * (len(held(a)) + len(held(b)) - both):
                    links.append((int(ids[a]), int(ids[b])))
                    comps[comps == comps[b]] = comps[a]
        return pa.table([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])

    where = ["band", "bucket", "i", "j"]
    # What is stored are members with their signatures, not pairs: these are found again where the sets are.
    named = stored(dealt.groupBy(*where).applyInArrow(likely, dealt.schema), "likely")
    return named.join(sets, ["doc_id", "key"]).groupBy(*where).applyInArrow(confirm, "u long, v long")


def _own_links(signed: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (u, v) between the classes of documents that have several texts."""
    taking_part = signed.select("doc_id", "key").filter("key IS NOT NULL AND doc_id IS NOT NULL")
    several = taking_part.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a < b")
    several = stored(several.select("doc_id"), "several")
    names = taking_part.join(several, "doc_id").join(reps.select("key", F.col("doc_id").alias("u")), "key").select("doc_id", "u").distinct()
    return names.join(names.groupBy("doc_id").agg(F.min("u").alias("v")), "doc_id").filter("u <> v").select("u", "v")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; links need 100 * intersection >= percent * union of the shingle sets.

    Letters A-Z count as lower case. A text without words (null, empty, white space) has an empty set and is linked with
    nothing. ``component_id`` is the smallest doc_id reachable, ``kept`` says that it is the row's own. A row without doc_id takes no
    part: its component_id is null and it is kept. Rows with one doc_id are one document: linked as soon as one of
    them is. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    signed = stored(signatures(docs, width), "signatures")
    # Equal sets fall together before any bucket is made: a group of exact copies is one row per task from here on.
    reps = stored(
        signed.filter("key IS NOT NULL AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig")), "classes"
    )
    bands = F.posexplode(F.array(*[F.xxhash64(F.substring("sig", 1 + 4 * ROWS * b, 4 * ROWS)) for b in range(BANDS)])).alias("band", "bucket")
    banded = reps.select("doc_id", bands)
    hubs = stored(banded.groupBy("band", "bucket").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n"), "hubs")
    members = stored(banded.join(hubs, ["band", "bucket"]), "members")
    sets = stored(sets_of(docs, stored(members.select("doc_id").distinct(), "involved"), width), "sets")
    pairs = members.filter("doc_id <> hub").select("doc_id", "hub").distinct()
    near = pairs.join(sets, "doc_id").join(sets.select(F.col("doc_id").alias("hub"), F.col("set").alias("hub_set")), "hub")
    links = stored(near.filter(_alike(F.col("set"), F.col("hub_set"), percent)).select(F.col("doc_id").alias("u"), F.col("hub").alias("v")), "links")
    links = links.unionByName(_own_links(signed, reps))
    labels = components(links)
    more = stored(_blocks(members, reps, labels, sets, percent), "more")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    classes = stored(_labelled(reps.select("key", "doc_id"), labels).select("key", F.col("component").alias("component_id")), "components")
    found = signed.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")).join(classes, "key", "left")
    own = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without the documents that a smaller doc_id of their component stands for.

    A doc_id goes with all its rows as soon as one of its texts is such a copy; rows that are repeated whole all stay.
    """
    copies = stored(near_duplicates(docs, width, percent).filter("NOT kept").select(F.col("doc_id").alias("__copy")).distinct(), "copies")
    named = F.broadcast(copies) if copies.count() <= FEW else copies
    return docs.join(named, F.col("doc_id").cast("long") == F.col("__copy"), "left_anti")
