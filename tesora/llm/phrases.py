"""Operator 12: phrase collocations by Toivonen's mining.

1. A sample of documents is mined level by level under a lowered threshold. What is frequent in it is proposed: words,
   then phrases whose two shorter parts are proposed.
2. A pass over all documents counts every word, every proposed phrase, and the negative border: phrases that are not
   proposed although both shorter parts are.
3. Words and border phrases that turn out frequent are border failures. They are proposed as well, and a further pass
   counts what that adds to the proposals and to their border, until a pass brings no failure. Every part of a frequent
   phrase is frequent, so the border of the last pass leaves nothing out.

All passes over all documents count phrases as text. The sample is counted under 64-bit hashes, and tasks know the
proposals as bitmaps of fixed size: a phrase that only seems proposed is counted exactly and then found infrequent.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesora.llm.common import in_parts, ship, stored, text_of

BITS = 26
WORDS_KEPT = 150_000  # that a task numbers before it starts anew
PART = 3 << 20  # bytes of texts that a task counts at once
SLICE = 1 << 20

# Breaks become a byte that UTF-8 never holds, A-Z lower case.
_PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r" + bytes(range(65, 91)), b"\xff" * 10 + bytes(range(97, 123)))
_EDGE = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Numbering(dict):
    """Numbers of words from 1 on, in order of appearance; 0 is a break between pieces."""

    def __init__(self) -> None:
        super().__init__({b"\xff": 0})
        self.words: list[bytes] = [b"\xff"]

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append(word)
        return n

    def text(self, text: bytes) -> list[np.ndarray]:
        """A text's words and breaks, and a break at its end. Long texts are read in slices that end between words."""
        out, at = [], 0
        while at < len(text):
            edge = _EDGE.search(text, at + SLICE)
            end = edge.start() if edge else len(text)
            found = text[at:end].translate(_PLAIN).replace(b"\xff", b" \xff ").split()
            out.append(np.fromiter(map(self.__getitem__, found), np.int64, len(found)))
            at = end
        out.append(np.zeros(1, np.int64))
        return out


@dataclass(frozen=True)
class Proposed:
    """What is proposed: a bitmap of phrase hashes for each size but the longest, which no further phrase rests on."""

    maps: tuple[np.ndarray, ...]

    @classmethod
    def nothing(cls, longest: int, bits: int) -> Proposed:
        return cls(tuple(np.zeros(2**bits // 64, np.uint64) for _ in range(longest - 1)))

    def has(self, size: int, keys: np.ndarray) -> np.ndarray:
        table = self.maps[size - 1]
        at = keys >> np.uint64(64 - (len(table) * 64).bit_length() + 1)
        return ((table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)

    def with_keys(self, found: DataFrame) -> Proposed:
        """Adds rows of (size, key). The driver gets the words of the bitmaps at most, whatever the number of rows."""
        maps = [m.copy() for m in self.maps]
        bits = (len(maps[0]) * 64).bit_length() - 1
        bit = F.shiftrightunsigned("key", 64 - bits)
        word = found.select("size", (bit / 64).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - bits}) % 64 as int))").alias("b"))
        table = word.groupBy("size", "w").agg(F.bit_or("b").alias("b")).toArrow()
        size, w, b = (table.column(c).to_numpy() for c in ("size", "w", "b"))
        for i, m in enumerate(maps):
            m[w[size == i + 1]] |= b[size == i + 1].view(np.uint64)
        return Proposed(tuple(maps))

    def same(self, other: Proposed) -> bool:
        return all(np.array_equal(a, b) for a, b in zip(self.maps, other.maps))

    def sent(self, spark: SparkSession) -> Broadcast:
        """For tasks, compressed: sparse bitmaps take a few bytes a phrase, full ones their fixed size."""
        return spark.sparkContext.broadcast([zstandard.compress(m.tobytes(), 1) for m in self.maps])

    @classmethod
    def received(cls, sent: Broadcast) -> Proposed:
        return cls(tuple(np.frombuffer(zstandard.decompress(m), np.uint64) for m in sent.value))


def _runs(a: np.ndarray, place: np.ndarray, size: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The different runs of ``size`` numbers at the places, a row each, and how often each stands there."""
    bits = n_words.bit_length()
    if bits * size <= 63:
        code = np.zeros(len(place), np.int64)
        for i in range(size):
            code = (code << bits) | a[place + i]
        code.sort()
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        shifts = bits * np.arange(size - 1, -1, -1)
        return (code[first, None] >> shifts) & ((1 << bits) - 1), np.diff(np.append(first, len(code)))
    code = a[place]
    for i in range(1, size):
        _, code = np.unique((code << 32) | a[place + i], return_inverse=True)
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return a[place[first, None] + np.arange(size)], n


@dataclass(frozen=True)
class Hashes:
    """Hashes of the words by number, and how those of a language's phrases follow from them, word by word."""

    firsts: np.ndarray
    later: list[np.ndarray]

    @classmethod
    def of(cls, words: np.ndarray, lang: str, later: list[np.ndarray]) -> Hashes:
        return cls(_mix(words ^ np.uint64(xxhash.xxh3_64_intdigest(lang))), later)

    def one_more(self, key: np.ndarray, size: int, last: np.ndarray) -> np.ndarray:
        return _mix(key * np.uint64(3) + self.later[size - 2][last])

    def runs(self, runs: np.ndarray) -> np.ndarray:
        key = self.firsts[runs[:, 0]]
        for i in range(1, runs.shape[1]):
            key = self.one_more(key, i + 1, runs[:, i])
        return key


def _later(words: np.ndarray, longest: int) -> list[np.ndarray]:
    return [_mix(words + np.uint64(size)) for size in range(2, longest + 1)]


def _count(a: np.ndarray, n_words: int, hashes: Hashes, now: Proposed, before: Proposed | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(runs of numbers, counts) of one language's words, for what ``now`` counts and ``before`` did not."""
    if before is None:  # the first pass counts all words
        n = np.bincount(a, minlength=1)
        n[0] = 0
        runs = np.flatnonzero(n)[:, None]
        if len(runs):
            yield runs, n[runs[:, 0]]
    key, new = hashes.firsts[a], a > 0
    old = new & before.has(1, key) if before else np.zeros(len(a), bool)
    new = new & now.has(1, key)
    for size in range(2, len(now.maps) + 2):
        new, old = new[:-1] & new[1:], old[:-1] & old[1:]
        if not new.any():
            return
        place = np.flatnonzero(new & ~old)
        if len(place):
            yield _runs(a, place, size, n_words)
        if size <= len(now.maps):
            key = hashes.one_more(key[:-1], size, a[size - 1 :])
            new = new & now.has(size, key)
            old = old & before.has(size, key) if before else old


def _passed(docs: DataFrame, sent_now: Broadcast, sent_before: Broadcast | None, schema: str, emit) -> DataFrame:
    """One pass: ``emit`` gets a language, runs, counts, words and hashes, and makes Arrow batches of them."""
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = Proposed.received(sent_now), Proposed.received(sent_before) if sent_before else None
        words, hashed = Numbering(), np.zeros(1, np.uint64)
        for part in in_parts(source, limit=PART):
            if len(words) > WORDS_KEPT:
                words, hashed = Numbering(), np.zeros(1, np.uint64)
            of: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                of.setdefault(lang, []).extend(words.text(text))
            hashed = np.concatenate([hashed, np.array([xxhash.xxh3_64_intdigest(w) for w in words.words[len(hashed) :]], np.uint64)])
            later = _later(hashed, len(now.maps) + 1)
            for lang, arrays in of.items():
                hashes = Hashes.of(hashed, lang, later)
                for runs, n in _count(np.concatenate(arrays), len(words.words), hashes, now, before):
                    yield emit(lang, runs, n, words.words, hashes)

    return docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(batches, schema)


def tally(docs: DataFrame, sent_now: Broadcast, sent_before: Broadcast | None = None) -> DataFrame:
    """(lang, phrase, n) added up over (lang, text): all words, proposed phrases and border phrases that no pass with the
    proposals ``sent_before`` has counted; the empty phrase for all words of a language."""

    def emit(lang: str, runs: np.ndarray, n: np.ndarray, words: list[bytes], hashes: Hashes) -> pa.RecordBatch:
        tail = b"\n" + lang.encode()  # no phrase holds a line end
        text = [b" ".join([words[w] for w in run]) + tail for run in runs.tolist()]
        if runs.shape[1] == 1:
            text, n = [*text, tail], np.append(n, n.sum())
        return pa.RecordBatch.from_arrays([pa.array(text, pa.binary()), pa.array(n)], ["named", "n"])

    counted = _passed(docs, sent_now, sent_before, "named binary, n long", emit).groupBy("named").agg(F.sum("n").alias("n"))
    named = F.col("named").cast("string")
    phrase = F.substring_index(named, "\n", 1)
    return counted.select(F.substr(named, F.length(phrase) + 2).alias("lang"), phrase.alias("phrase"), "n")


def keys(found: DataFrame, longest: int) -> DataFrame:
    """(size, key) of counted phrases that a longer one may rest on."""
    ship(found.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            words, of = Numbering(), {}
            for lang, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()):
                run = [words[w] for w in phrase.split(b" ")]
                of.setdefault((lang, len(run)), []).append(run)
            hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in words.words], np.uint64)
            later = _later(hashed, longest)
            for (lang, size), runs in of.items():
                key = Hashes.of(hashed, lang, later).runs(np.array(runs))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), size, np.int32)), pa.array(key.view(np.int64))], ["size", "key"])

    inner = found.filter((F.col("phrase") != "") & (F.regexp_count("phrase", F.lit(" ")) < longest - 1))
    return inner.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(batches, "size int, key long")


def propose(docs: DataFrame, sample: float, least: int, longest: int, bits: int) -> Proposed:
    """Mines the documents whose hash falls into the sampled share, under the lowered threshold ``least``."""
    spread = 1 << 20
    part = docs.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(spread)) < int(sample * spread))

    def emit(lang: str, runs: np.ndarray, n: np.ndarray, words: list[bytes], hashes: Hashes) -> pa.RecordBatch:
        size = pa.array(np.full(len(n), runs.shape[1], np.int32))
        return pa.RecordBatch.from_arrays([size, pa.array(hashes.runs(runs).view(np.int64)), pa.array(n)], ["size", "key", "n"])

    now, sent = Proposed.nothing(longest, bits), [None]
    for _ in range(longest - 1):
        sent.append(now.sent(docs.sparkSession))
        counted = _passed(part, sent[-1], sent[-2], "size int, key long, n long", emit)
        now = now.with_keys(counted.groupBy("size", "key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))
    for old in sent[1:]:
        old.destroy()
    return now


def frequent(docs: DataFrame, least: int = 10, longest: int = 3, sample: float = 0.25, lowered: int = 3, bits: int = BITS) -> DataFrame:
    """(lang, size, phrase, n) of every word and phrase of up to ``longest`` words with ``least`` occurrences or more, and a row of
    size 0 and empty phrase with each language's number of words. ``docs`` has (lang, text), without nulls. The sample decides
    how many passes are needed, never the result."""
    now, sent, passes = propose(docs, sample, lowered, longest, bits), [None], []
    while True:
        sent.append(now.sent(docs.sparkSession))
        passes.append(stored(tally(docs, sent[-1], sent[-2]).filter(F.col("n") >= least), "phrases"))
        grown = now.with_keys(keys(passes[-1], longest))
        if grown.same(now):
            break
        now = grown
    for old in sent[1:]:
        old.destroy()
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    size = F.when(F.col("phrase") == "", 0).otherwise(F.regexp_count("phrase", F.lit(" ")) + 1)
    return every.select("lang", size.alias("size"), "phrase", "n")


def collocations(
    docs: DataFrame, least: int = 10, longest: int = 3, inside: int = 50, top: int = 2000, **settings: float
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases of 2 to ``longest`` words.

    A phrase counts as often as it stands in a piece, overlaps included. Its score is that of its lowest-scoring cut, the
    first of equal ones. Phrases that stand in a longer frequent one with at least ``inside`` per cent of their count are
    left out. A null language is ``und``, a null or empty text has no pieces; repeated rows count each time; without
    frequent phrases there are no rows. Further columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().cast("string").alias("text"))
    counts = stored(frequent(rows, least, longest, **settings), "counts")
    words = F.split("phrase", " ", -1)
    phrases = counts.filter("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("words"))
    text = lambda part: F.array_join(part, " ")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    parts = cuts.select(
        "lang", "phrase", "a", "k",
        F.explode(F.array(
            F.struct(F.lit(True).alias("left"), text(F.slice("words", 1, F.col("k"))).alias("part")),
            F.struct(F.lit(False).alias("left"), text(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k"))).alias("part")),
        )).alias("p"),
    ).select("lang", "phrase", "a", "k", "p.left", "p.part")
    of_parts = counts.filter("size >= 1").select("lang", F.col("phrase").alias("part"), "n")
    sides = parts.join(of_parts, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r")
    )
    wide = lambda c: f"cast({c} as decimal(18, 0))"
    exact = F.expr(f"({wide('a')} * {wide('a')} * cast(1000000 as decimal(7, 0))) div ({wide('l')} * {wide('r')})")
    best = sides.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    windows = phrases.filter("size >= 3").select("lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("width"))
    places = windows.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)))
    holders = places.groupBy("lang", text(F.slice("words", F.col("at"), F.col("width"))).alias("phrase")).agg(F.max("a").alias("longer"))
    alone = best.join(holders, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))

    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = alone.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    total = counts.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "best.l", "best.r", "n", "best.score")
