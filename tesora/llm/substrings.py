"""Operator 9: substring dedup with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words. A window's minimiser is the least hash of its
``GRAM``-word grams, so equal windows have equal minimisers. Neighbouring windows with one minimiser form a
segment, and a segment's minimiser is its route: all places where a window stands go to one shard, and a shard
is searched with its own segments only, not with the whole corpus.

1. Equal texts are one class: all but the smallest doc_id's are covered by it. What follows sees one text of each class.
2. Minimisers found in one text only lead nowhere. The others are set in a bitmap of fixed size, which spares rows and
   decides nothing. Minimisers of very many texts are split: each of their windows is a segment by itself, routed by
   its own hash.
3. Equal segments are one, with the smallest doc_id. Each shard sorts its segments' suffixes (as far as a window
   reaches), keeps their Burrows-Wheeler transform as a wavelet matrix of packed bits, and streams the segments through it: backward search
   extends every window word by word, and each match that reaches WINDOW reports its suffix interval, whose least
   doc_id is the first document with these words.
4. Segments take these figures back to the texts they come from; a window whose first document has a smaller doc_id
   covers its words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.llm.common import ship, stored

WINDOW = 13
GRAM = 6  # long enough that grams of common words seldom meet by chance
BITS = 28  # of the bitmap of repeated minimisers
HOT_BITS = 22
HOT = 1000  # texts with one minimiser from which on its windows are split
SHARD_WORDS = 200_000
FEW = 1_000_000  # ids that may be broadcast; more are joined by a shuffle


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mixed(out + hashes[i : i + n])
    return out


def minimisers(words: list[bytes]) -> np.ndarray:
    """One for each window, none for fewer words than a window has."""
    if len(words) < WINDOW:
        return np.zeros(0, np.uint64)
    grams = _rolled(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), GRAM)
    return np.lib.stride_tricks.sliding_window_view(grams, WINDOW - GRAM + 1).min(axis=1)


def _bit(table: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    at = values >> np.uint64(64 - bits)
    return ((table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def _bitmap(values: DataFrame, bits: int) -> np.ndarray:
    """The driver gets 2**bits bits at most, whatever the number of values."""
    at = F.shiftrightunsigned("value", 64 - bits)
    words = values.select((at / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(value, {64 - bits}) % 64 as int))").alias("b"))
    table = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(2**bits // 64, np.uint64)
    out[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return out


class FMIndex:
    """Index of sequences of whole numbers above 0 that each end in 0: suffix order as far as ``reach``, wavelet matrix, a figure for each suffix."""

    def __init__(self, text: np.ndarray, figure: np.ndarray, reach: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while width < reach:
            after = np.zeros(n, np.int64)
            after[: max(n - width, 0)] = rank[width:] + 1
            rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1] if n else rank
            width *= 2
        order = np.argsort(rank, kind="stable")
        self.n, self.figure = n, figure[order]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text))]) if n else np.zeros(2, np.int64)
        self.levels = max(1, int(text.max(initial=0)).bit_length())
        current, self.bits, self.counts, self.zeros = text[order - 1] if n else text, [], [], []
        for level in reversed(range(self.levels)):
            bit = ((current >> level) & 1).astype(np.uint8)
            packed = np.packbits(np.concatenate([bit, np.zeros(128 - n % 64, np.uint8)]), bitorder="little").view("<u8")
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int32))
            self.zeros.append(n - int(bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        self.start = self._descend(np.arange(len(self.first) - 1), np.zeros(len(self.first) - 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i, level in enumerate(reversed(range(self.levels))):
            word = at >> 6
            below = self.bits[i][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.counts[i][word] + np.bitwise_count(below)
            at = np.where((symbol >> level) & 1, ones + self.zeros[i], at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place of the transform."""
        return self._descend(symbol, at) - self.start[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lengths, lo, hi): how far each row of patterns matches from its end backwards, and the interval of that match."""
        last = patterns[:, -1]
        known = last < len(self.first) - 1
        lo = np.where(known, self.first[np.minimum(last, len(self.first) - 2)], 0)
        hi = np.where(known, self.first[np.minimum(last, len(self.first) - 2) + 1], 0)
        length = (hi > lo).astype(np.int64)
        live = np.flatnonzero(hi > lo)
        for column in reversed(range(patterns.shape[1] - 1)):
            symbol = patterns[live, column]
            inside = symbol < len(self.first) - 1
            live, symbol = live[inside], symbol[inside]
            ends = self.rank(np.concatenate([symbol, symbol]), np.concatenate([lo[live], hi[live]])) + np.tile(self.first[symbol], 2)
            down, up = ends[: len(live)], ends[len(live) :]
            found = up > down
            live = live[found]
            lo[live], hi[live] = down[found], up[found]
            length[live] += 1
        return length, lo, hi

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least figure of each interval; intervals are equal or apart, and none is empty."""
        if not len(lo):
            return np.zeros(0, np.int64)
        begins, where = np.unique(lo, return_inverse=True)
        ends = np.zeros(len(begins), np.int64)
        ends[where] = hi
        cuts = np.stack([begins, ends], axis=1).ravel()
        return np.minimum.reduceat(np.append(self.figure, np.iinfo(np.int64).max), cuts)[::2][where]


def first_documents(segments: list[bytes], names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, least): each segment's number of windows, and for all of these one after another the least name of a segment with the window."""
    split = [segment.split(b" ") for segment in segments]
    sizes = np.array([len(words) for words in split], np.int64)
    ids: dict[bytes, int] = {}
    number = ids.setdefault
    # Each segment ends in 0, which stands in no window.
    text = np.fromiter((x for words in split for x in (*(number(w, len(ids) + 1) for w in words), 0)), np.int64, int(sizes.sum() + len(sizes)))
    index = FMIndex(text, np.repeat(names, sizes + 1), WINDOW)
    counts = sizes - WINDOW + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    starts = np.repeat(begin - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    least = np.zeros(len(starts), np.int64)
    for at in range(0, len(starts), 50_000):
        some = starts[at : at + 50_000]
        length, lo, hi = index.search(text[some[:, None] + np.arange(WINDOW)])
        assert (length == WINDOW).all()  # each window stands in its own segment
        least[at : at + 50_000] = index.least(lo, hi)
    return counts, least


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]


def _profile(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, text_key, n_words, kept_sha256 of all words) of every row."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            keys, sizes, digests = [], [], []
            for text in _texts(batch):
                words = text.split()
                whole = b" ".join(words)
                keys.append(xxhash.xxh3_128_digest(whole))
                sizes.append(len(words))
                digests.append(hashlib.sha256(whole).hexdigest())
            columns = [batch.column("doc_id"), batch.column("row_key"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "text_key", "n_words", "kept_sha256"])

    return docs.mapInArrow(batches, "doc_id long, row_key long, text_key binary, n_words long, kept_sha256 string")


def _fingerprints(docs: DataFrame) -> DataFrame:
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, 500):
                found = [np.unique(minimisers(text.split())) for text in _texts(batch.slice(at, 500))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["value"])

    return docs.select("text").mapInArrow(batches, "value long")


def _segments(docs: DataFrame, repeated: np.ndarray, hot: np.ndarray) -> DataFrame:
    """(doc_id, row_key, start, route, segment, words) of the segments that may stand in several texts; start is that of the first window."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((repeated, hot))  # both of fixed size

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_several, in_many = shared.value
        for batch in source:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows, starts, routes, keys, texts = [], [], [], [], []
                for row, text in enumerate(_texts(part)):
                    words = text.split()
                    low = minimisers(words)
                    if not len(low):
                        continue
                    alone = _bit(in_many, low, HOT_BITS)
                    cut = np.ones(len(low), bool)
                    cut[1:] = (low[1:] != low[:-1]) | alone[1:]
                    begins = np.flatnonzero(cut)
                    ends = np.append(begins[1:], len(low))
                    wanted = _bit(in_several, low[begins], BITS)
                    for a, b, split in zip(begins[wanted].tolist(), ends[wanted].tolist(), alone[begins[wanted]].tolist()):
                        own = b" ".join(words[a : b + WINDOW - 1])
                        rows.append(row)
                        starts.append(a)
                        keys.append(xxhash.xxh3_128_digest(own))
                        routes.append(xxhash.xxh3_64_intdigest(own, 1) if split else int(low[a]))
                        texts.append(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int32())), part.column("row_key").take(pa.array(rows, pa.int32())), pa.array(starts, pa.int32()), pa.array(np.array(routes, np.uint64).view(np.int64)), pa.array(keys, pa.binary()), pa.array(texts, pa.binary())],
                    ["doc_id", "row_key", "start", "route", "segment", "words"],
                )

    return docs.mapInArrow(batches, "doc_id long, row_key long, start int, route long, segment binary, words binary")


def _covering(found: DataFrame) -> DataFrame:
    """(segment, least): the first documents of a distinct segment's windows, by the shards' indexes. Segments that stand in one
    place only and whose windows all begin there are left out: they cover nothing and nothing covers them."""
    distinct = stored(found.groupBy("route", "words").agg(F.min("doc_id").alias("name"), F.count("*").alias("n")), "segments")
    size = distinct.agg(F.sum(F.octet_length("words") / 6).alias("n")).collect()[0].n or 0
    shards = max(1, -(-int(size) // SHARD_WORDS))

    def search(table: pa.Table) -> pa.Table:
        words, names = table.column("words").to_pylist(), table.column("name").to_numpy()
        counts, least = first_documents(words, names)
        ends = np.concatenate([[0], np.cumsum(counts)])
        earlier = np.add.reduceat((least < np.repeat(names, counts)).astype(np.int64), ends[:-1]) > 0
        told = np.flatnonzero(earlier | (table.column("n").to_numpy() > 1))
        keys = pa.array([xxhash.xxh3_128_digest(words[i]) for i in told.tolist()], pa.binary())
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(least)).take(pa.array(told))
        return pa.table([keys, lists], names=["segment", "least"])

    dealt = distinct.select("words", "name", "n", F.pmod(F.xxhash64("route"), F.lit(shards)).alias("shard"))
    return stored(dealt.groupBy("shard").applyInArrow(search, "segment binary, least array<long>"), "least")


def _named(docs: DataFrame) -> DataFrame:
    """Rows are told apart by doc_id and a hash of their text, so that a repeated doc_id does no harm."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.withColumn("row_key", F.xxhash64("doc_id", "text"))


def _covered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row's profile with ``copy``, whether an earlier row has all its words; and (doc_id, row_key, parts) of the
    other rows with covered windows: parts are (start, hit), hit telling of each window from start on whether it is covered."""
    profile = stored(_profile(docs), "profile")
    classes = profile.filter("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    marked = profile.join(stored(classes.drop("n"), "classes"), "text_key", "left")
    marked = stored(marked.withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))).drop("first_id", "text_key"), "marked")
    copies = marked.filter("copy").select("doc_id", "row_key").distinct()
    firsts = docs.filter("doc_id IS NOT NULL").join(F.broadcast(copies) if copies.count() <= FEW else copies, ["doc_id", "row_key"], "left_anti")
    repeated = stored(_fingerprints(firsts).groupBy("value").agg(F.count("*").alias("n")).filter("n > 1"), "repeated")
    found = stored(_segments(firsts, _bitmap(repeated, BITS), _bitmap(repeated.filter(F.col("n") > HOT), HOT_BITS)), "places")
    hits = (
        found.select("doc_id", "row_key", "start", "segment")
        .join(_covering(found), "segment")
        .withColumn("hit", F.transform("least", lambda x: x < F.col("doc_id")))
        .filter(F.exists("hit", lambda x: x))
    )
    parts = hits.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("start", "hit")).alias("parts"))  # of one document
    return marked, stored(parts, "covered")


def _cut(rows: DataFrame, with_text: bool) -> DataFrame:
    """(doc_id, row_key, n_words, n_removed, kept_sha256, and text if asked for) of rows with text, parts and copy."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                sizes, gone, digests, texts = [], [], [], []
                for text, found, copy in zip(_texts(part), part.column("parts").to_pylist(), part.column("copy").to_pylist()):
                    words = text.split()
                    windows = np.zeros(len(words) + 1, np.int64)
                    for p in found or ():
                        hit = np.flatnonzero(p["hit"]) + p["start"]
                        np.add.at(windows, hit, 1)
                        np.add.at(windows, hit + WINDOW, -1)
                    away = np.cumsum(windows)[:-1] > 0
                    if copy and len(words) >= WINDOW:
                        away[:] = True
                    kept = b" ".join(w for w, x in zip(words, away.tolist()) if not x)
                    sizes.append(len(words))
                    gone.append(int(away.sum()))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        texts.append(kept.decode())
                columns = [part.column("doc_id"), part.column("row_key"), *(pa.array(x, pa.int64()) for x in (sizes, gone)), pa.array(digests)]
                columns += [pa.array(texts)] if with_text else []
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "n_words", "n_removed", "kept_sha256", "text"][: len(columns)])

    schema = "doc_id long, row_key long, n_words long, n_removed long, kept_sha256 string" + (", text string" if with_text else "")
    return rows.select("doc_id", "row_key", "text", "parts", "copy").mapInArrow(batches, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, text) of every row; ``text`` has the kept words joined by one space.

    Words are runs of anything but ASCII white space, compared as they are. A word goes if a window over it also
    starts in a row with a smaller doc_id; windows are judged on the input. A null text counts as empty; fewer words than
    a window has are never covered. A row without doc_id keeps its words and covers none. Rows with one doc_id do
    not cover each other, so repeated rows all stay. An empty table gives an empty result.
    """
    ship(docs.sparkSession)
    docs = _named(docs)
    marked, parts = _covered(docs)
    copies = marked.select("doc_id", "row_key", "copy").distinct()
    same = lambda other: docs["doc_id"].eqNullSafe(other["doc_id"]) & (docs["row_key"] == other["row_key"])
    rows = docs.join(copies, same(copies)).join(parts, same(parts), "left").select(docs["doc_id"], docs["row_key"], "text", "parts", "copy")
    return _cut(rows, with_text=True).drop("row_key")


def removal_digests(docs: DataFrame) -> DataFrame:
    """``remove_repeats`` without the texts: only rows with a covered part are read again."""
    ship(docs.sparkSession)
    docs = _named(docs)
    marked, parts = _covered(docs)
    touched = parts.select("doc_id", "row_key")
    texts = docs.join(F.broadcast(touched), ["doc_id", "row_key"], "left_semi") if touched.count() <= FEW else docs
    changed = _cut(texts.join(parts, ["doc_id", "row_key"]).withColumn("copy", F.lit(False)), with_text=False).distinct()
    changed = changed.select("doc_id", "row_key", F.col("n_removed").alias("gone"), F.col("kept_sha256").alias("digest"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    all_gone = F.col("copy") & (F.col("n_words") >= WINDOW)
    return marked.join(changed, ["doc_id", "row_key"], "left").select(
        "doc_id",
        "n_words",
        F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(all_gone, none).otherwise(F.coalesce("digest", "kept_sha256")).alias("kept_sha256"),
    )
