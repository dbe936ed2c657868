"""Operator 6: benchmark decontamination by spaced seeds.

Tokens are words in lower case (A-Z) without ASCII punctuation. A seed hashes the
tokens at a mask's places and ignores those between, so that a changed word
spoils only the seeds that look at it. At least one of ``MASKS`` hits any 13 tokens of which
up to three are changed.

1. The benchmark's seeds are set in a bitmap of fixed size, which Spark ors together. It only spares rows: every
   document's seeds at all places are looked up in it, and those found are joined with the benchmark's seeds.
2. A joined pair gives an alignment: document, item, and the distance between their places.
3. Each alignment is verified on the tokens: any ``least`` tokens in a row with ``matched`` matches. Of an item with fewer
   tokens the whole is the window, with the same share of matches; runs of three (``NEAR``) are its seeds, one of which is left by
   as many changes as may be. An item of fewer than ``SHORTEST`` tokens must be there whole, and is its own seed.

In a run of one repeated token all places have the same seed. A pair of places that both repeat the seed before them gives the
alignment of the pair before, so only pairs of which one place is the ``first`` of its run are joined.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.llm.common import in_parts, ship, stored

# Places that each mask looks at.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 6, 7, 9), (0, 2, 3, 5, 8, 9), (0, 4, 5, 7, 8, 11), (0, 1, 2, 6, 9, 10), (0, 1, 4, 5, 6, 7), (0, 1, 4, 6, 7, 8))
SHORTEST = 1 + max(MASKS[0])  # from here on the first mask fits
NEAR = (0, 1, 2)  # of items from SHORTEST to LONG - 1 tokens
LONG = 13
BITS = 26
FEW = 200_000  # ids that may be broadcast; more are joined by a shuffle
NARROW = 32 << 20  # bytes of ids and offsets that may be broadcast, likewise
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MARKS = string.punctuation.encode()


def tokens(text: bytes) -> np.ndarray:
    words = text.translate(_LOWER, _MARKS).split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def seeds(found: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    """The hash of each placing of a mask over tokens."""
    n = len(found) - places[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(places) * 257 + places[-1], np.uint64)
    for place in places:
        out = _mixed(out + found[place : place + n])
    return out


def bit_of(values: np.ndarray) -> np.ndarray:
    return values >> np.uint64(64 - BITS)


def short_masks(n: int) -> tuple[tuple[int, ...], ...]:
    """What is looked up of an item of n tokens besides MASKS."""
    return (NEAR,) if SHORTEST <= n < LONG else (tuple(range(n)),) if 0 < n < SHORTEST else ()


def first_of_run(hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    out[1:] = hashes[1:] != hashes[:-1]
    return out


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_id, pos, span, first) of a benchmark; an item too short for a mask has none of it. ``span``: tokens of a short mask, else 0."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for name, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                found = tokens(text or b"")
                for span, places in [*((0, m) for m in MASKS), *((len(m), m) for m in short_masks(len(found)))]:
                    hashes = seeds(found, places)
                    n = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes.view(np.int64)), pa.array([name] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array([span] * n, pa.int32()), pa.array(first_of_run(hashes))],
                        ["seed", "item_id", "pos", "span", "first"],
                    )

    return _texts(items, "item_id").mapInArrow(batches, "seed long, item_id long, pos int, span int, first boolean")


def _texts(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))


def bitmap(found: DataFrame) -> np.ndarray:
    """2**BITS bits, in 64-bit words; the driver gets these words only, whatever the benchmark's size."""
    bit = F.shiftrightunsigned("seed", 64 - BITS)
    word = found.select((bit / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - BITS}) % 64 as int))").alias("b"))
    out = np.zeros(2**BITS // 64, np.uint64)
    table = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return out


def windows(same: np.ndarray, n: int, least: int, matched: int) -> tuple[int, int, int]:
    """(begin, end, matches) of the windows that hold matches enough of an item of n tokens, those that meet as one; (0, 0, 0) if none does.

    Of several the one with the most matches, then the first. Changed tokens at its ends are left out down to one window's length.
    """
    size = min(least, n)
    need = n if n < SHORTEST else -(-matched * size // least)
    if not 0 < size <= len(same):
        return 0, 0, 0
    total = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(total[size:] - total[:-size] >= need)
    best = (0, 0, 0)
    for run in np.split(good, np.flatnonzero(np.diff(good) > size) + 1) if len(good) else ():
        begin, end = int(run[0]), int(run[-1]) + size
        while end - begin > size and not same[begin]:
            begin += 1
        while end - begin > size and not same[end - 1]:
            end -= 1
        best = max(best, (begin, end, int(total[end] - total[begin])), key=lambda x: x[2])
    return best


def _hits(docs: DataFrame, masks: list[tuple[int, ...]], bits: np.ndarray) -> DataFrame:
    """(row_key, seed, at, first) of the places of docs (row_key, text) whose seeds are set in ``bits``."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part in in_parts(source, limit=1 << 22):
            columns: list[tuple[np.ndarray, ...]] = []
            for key, text in zip(part.column("row_key").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                own = tokens(text or b"")
                for places in masks:
                    hashes = seeds(own, places)
                    bit = bit_of(hashes)
                    hit = np.flatnonzero((table[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1))
                    if len(hit) and len(places) < SHORTEST and places != NEAR:
                        hit = hit[np.unique(hashes[hit], return_index=True)[1]]  # whole items: their first place is enough
                    if len(hit):
                        columns.append((np.full(len(hit), key), hashes[hit].view(np.int64), hit.astype(np.int64), first_of_run(hashes)[hit]))
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*columns)], ["row_key", "seed", "at", "first"])

    return docs.mapInArrow(batches, "row_key long, seed long, at long, first boolean")


def alignments(hits: DataFrame, items: DataFrame) -> DataFrame:
    """(row_key, item_id, offset), each once however many seeds speak for it."""
    begin, repeat = items.filter("first").drop("first"), items.filter("NOT first").drop("first")
    pairs = hits.drop("first").join(begin, "seed").unionByName(hits.filter("first").drop("first").join(repeat, "seed"))
    return pairs.select("row_key", "item_id", (F.col("at") - F.col("pos")).alias("offset")).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 13, matched: int = 10) -> DataFrame:
    """(doc_id, item_id, start, length, matches, row_key): the best overlap of each document with each item of which it holds a passage.

    ``start`` counts the document's tokens. Documents without an overlap give no row, nor do null or empty texts and items.
    Rows are told apart by ``row_key``, a hash of doc_id and text, so a null or repeated doc_id does no harm; repeated rows
    and items give one result each time they differ in text.
    """
    ship(docs.sparkSession)
    items = stored(item_seeds(benchmark), "seeds")
    spans = sorted(r.span for r in items.filter("span > 0").select("span").distinct().collect())  # of 1 to 5 tokens: only those that occur
    masks = [*MASKS, *(tuple(range(n)) for n in spans)]
    keyed = _texts(docs, "doc_id").withColumn("row_key", F.xxhash64("doc_id", "text"))
    found = stored(_hits(keyed.select("row_key", "text"), masks, bitmap(items)), "hits")
    aligned = alignments(found, items.drop("span"))
    # The offsets of one document and item: no more than their tokens.
    listed = stored(aligned.groupBy("row_key", "item_id").agg(F.sort_array(F.collect_list("offset")).alias("offsets")), "listed")
    whole = _texts(benchmark, "item_id").filter("text IS NOT NULL").withColumnRenamed("text", "item").distinct()

    def verify(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(source):
            rows = []
            last, own = None, None
            for row in part.to_pylist():
                if row["text"] != last or own is None:
                    last, own = row["text"], tokens((row["text"] or "").encode())
                item, best = tokens(row["item"].encode()), None
                for offset in row["offsets"]:
                    lo, hi = max(offset, 0), min(offset + len(item), len(own))
                    begin, end, same = windows(own[lo:hi] == item[lo - offset : hi - offset], len(item), least, matched)
                    if same:
                        best = max(best or (0, 0, 0), (same, begin - end, -(lo + begin)))
                    if same == len(item):
                        break  # no later offset is better
                if best:
                    rows.append((row["doc_id"], row["item_id"], -best[2], -best[1], best[0], row["row_key"]))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "start", "length", "matches", "row_key"])

    # Ids and offsets alone may be broadcast; the items' texts are looked up afterwards.
    size = listed.agg(F.sum(24 + 8 * F.size("offsets").cast("long")).alias("n")).collect()[0].n or 0
    with_text = keyed.join(F.broadcast(listed) if size <= NARROW else listed, "row_key").join(whole, "item_id")
    return with_text.mapInArrow(verify, "doc_id long, item_id long, start long, length long, matches long, row_key long").distinct()


def clean(docs: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no passage of the benchmark."""
    found = stored(overlaps(docs, benchmark, **settings).select("row_key").distinct(), "leaks")
    named = F.broadcast(found) if found.count() <= FEW else found
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.join(named, key == found["row_key"], "left_anti")
