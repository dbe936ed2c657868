"""Operator 1: token ids in a compressed plane format.

A chunk holds the ids of consecutive whole documents. They are cut into blocks
of ``BLOCK`` ids (the last is shorter); every block is transposed into byte
planes (all lowest bytes, then all second bytes, ...) or bit planes, and every plane is
compressed by zstandard. The chunk's index lists where each block begins, so a
document is read by inflating only the blocks that hold it.

Chunks are rows of Parquet files, one group of files per shard of consecutive
doc_id, so they are written by Spark's committer on whatever store the path
names, and a lost executor's task is simply run again.

bytes of a chunk: for each block, for each plane, its length (4 bytes, little
endian) and then its zstandard frame.
"""

from __future__ import annotations

import gc
import struct
import unicodedata
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tesora.llm.common import shared_dir, ship
from tesora.llm.token_counts import byte_symbols, pre_tokens

BLOCK = 65_536
CHUNK = 4 * BLOCK
CACHE = 800_000
CHUNKS = (
    "shard int, chunk int, first long, n_ids long, planes string, doc_ids array<long>, lengths array<long>,"
    " blocks array<long>, bytes binary"
)


def pack_block(ids: np.ndarray, planes: str) -> bytes:
    """One block of unsigned 32-bit ids as compressed planes."""
    table = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bits":
        table = np.unpackbits(table, axis=1, bitorder="little")
        rows = [np.packbits(table[:, i]).tobytes() for i in range(32)]
    else:
        rows = [table[:, i].tobytes() for i in range(4)]
    level = zstandard.ZstdCompressor(level=1)
    frames = [level.compress(row) for row in rows]
    return b"".join(struct.pack("<I", len(frame)) + frame for frame in frames)


def unpack_block(data: bytes, n: int, planes: str) -> np.ndarray:
    table, at, inflate = [], 0, zstandard.ZstdDecompressor()
    for _ in range(32 if planes == "bits" else 4):
        (size,) = struct.unpack_from("<I", data, at)
        row = np.frombuffer(inflate.decompress(data[at + 4 : at + 4 + size]), np.uint8)
        table.append(np.unpackbits(row, count=n) if planes == "bits" else row)
        at += 4 + size
    joined = np.stack(table, axis=1)
    if planes == "bits":
        joined = np.packbits(joined, axis=1, bitorder="little")
    return np.ascontiguousarray(joined).view("<u4").reshape(-1)


def pack(ids: np.ndarray, planes: str = "bytes", block: int = BLOCK) -> tuple[bytes, list[int]]:
    """A chunk's bytes and where its blocks begin."""
    blocks = [pack_block(ids[i : i + block], planes) for i in range(0, len(ids), block)]
    begins = np.cumsum([0, *map(len, blocks)])[:-1].tolist() if blocks else []
    return b"".join(blocks), begins


def unpack(data: bytes, begins: list[int], n: int, planes: str = "bytes", lo: int = 0, hi: int | None = None, block: int = BLOCK) -> np.ndarray:
    """Ids lo to hi of a chunk; only blocks that hold some of them are inflated."""
    hi = n if hi is None else hi
    if lo >= hi:
        return np.zeros(0, np.uint32)
    ends = [*begins[1:], len(data)]
    wanted = range(lo // block, (hi - 1) // block + 1)
    ids = np.concatenate([unpack_block(data[begins[i] : ends[i]], min(block, n - i * block), planes) for i in wanted])
    return ids[lo - wanted[0] * block : hi - wanted[0] * block]


_SYMBOLS = dict(enumerate(byte_symbols()))
_PROBES = ("tokens", "straße", "añoœ", "жизнь")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class Ids(dict):
    """Ids of words (bytes) as little-endian bytes, by the tokenizers library.

    The vocabulary's normaliser and pre-tokens never cross ASCII white space, so a text's ids are those of its words, one
    after another. Pre-tokens not met before are given to the library: runs of letters, which are one pre-token each, to its
    model alone, others many at a time, where a final symbol's end mark tells where one ends. Where that cannot be told, the
    library gets each word by itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size(with_added_tokens=True)
        ends = [token.endswith("</w>") for token in map(self.library.id_to_token, range(size))]
        self.ends = np.array(ends)
        # Only proposes where pre-tokens end; the library's end marks confirm it.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")
        self.pieces: dict[str, bytes] = {}
        self.model, self.packed = self.library.model, [struct.pack("<I", i) for i in range(size)]
        self.by_model = all(self.letters(text) == self.alone(text) for text in _PROBES)

    def letters(self, text: str) -> bytes:
        """Ids of one pre-token of letters, without normaliser and pre-tokeniser; the model reads bytes as symbols."""
        symbols = text if text.isascii() else text.encode().decode("latin-1").translate(_SYMBOLS)
        return b"".join([self.packed[token.id] for token in self.model.tokenize(symbols)])

    def alone(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        plain: dict[bytes, str] = {}
        cut: dict[bytes, list[str]] = {}
        for word in words:
            given = word.decode()
            text = given.lower() if given.isascii() else unicodedata.normalize("NFC", given).lower()
            if text.isalpha() and "ς" not in text:
                plain[word] = text  # one pre-token
            elif any(mark in given for mark in self.special) or "ς" in text:
                self[word] = self.alone(given)  # special strings, and a letter whose lower case depends on its place
            else:
                letters = text.rstrip(_MARKS)
                cut[word] = [letters, text[len(letters) :]] if letters.isalpha() else pre_tokens(self.pattern, text)
        fresh = {piece for pieces in cut.values() for piece in pieces if piece not in self.pieces}
        fresh.update(piece for piece in plain.values() if piece not in self.pieces)
        others = []
        for piece in fresh:
            # Older letters are letters in every Unicode version.
            if self.by_model and piece.isalpha() and (piece.isascii() or max(piece) < "\u0500"):
                self.pieces[piece] = self.letters(piece)
            else:
                others.append(piece)
        for i in range(0, len(others), 4096):
            self.learn_pieces(others[i : i + 4096])
        for word, piece in plain.items():
            self[word] = self.pieces[piece]
        for word, pieces in cut.items():
            self[word] = b"".join(map(self.pieces.__getitem__, pieces))

    def learn_pieces(self, pieces: list[str]) -> None:
        ids = np.array(self.library.encode("\n".join(pieces), add_special_tokens=False).ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces):  # each piece has one end at least, so equal numbers prove one each
            self.pieces.update((piece, self.alone(piece)) for piece in pieces)
            return
        data, begin = ids.tobytes(), 0
        for piece, stop in zip(pieces, (stops * 4).tolist()):
            self.pieces[piece] = data[begin:stop]
            begin = stop

    def texts(self, texts: list[bytes]) -> list[bytes]:
        split = [text.split() for text in texts]
        found = [list(map(self.get, words)) for words in split]
        fresh = {word for words, ids in zip(split, found) for word, known in zip(words, ids) if known is None}
        if len(self) + len(fresh) > CACHE or len(self.pieces) > CACHE:
            self.clear()
            self.pieces.clear()
        self.learn(list(fresh))
        return [
            b"".join([self[word] if known is None else known for word, known in zip(words, ids)] if None in ids else ids)
            for words, ids in zip(split, found)
        ]


_kept: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _kept:
        _kept[path] = Ids(path)
    return _kept[path]


@contextmanager
def uncollected() -> Iterator[None]:
    """Words and ids form no cycles; the collector would walk the kept ones over and over."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, planes: str = "bytes", shards: int | None = None) -> None:
    """Encodes every text, appends ``end_id``, and writes chunks in ascending doc_id order (nulls first, ties by text).

    Documents are dealt to shards by doc_id ranges first, while they are still texts: ids are then made once, where they
    are packed. A null text is an empty one: its ids are the end id alone. No rows: a folder without chunks.
    """
    ship(docs.sparkSession)
    if planes not in ("bytes", "bits"):
        raise ValueError("planes: bytes or bits")

    def chunks(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = ids_of(vocabulary), struct.pack("<I", end_id)
        schema = pa.schema(
            [("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("planes", pa.string()),
             ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int64())), ("bytes", pa.binary())]
        )
        shard, chunk, first, size = -1, 0, 0, 0
        held: list[bytes] = []
        names: list[int | None] = []

        def out() -> pa.RecordBatch:
            nonlocal chunk, first, size, held, names
            ids = np.frombuffer(b"".join(held), "<u4")
            data, begins = pack(ids, planes)
            row = [shard, chunk, first, len(ids), planes, names, [len(x) // 4 for x in held], begins, data]
            chunk, first, size, held, names = chunk + 1, first + len(ids), 0, [], []
            return pa.RecordBatch.from_arrays([pa.array([value], field.type) for value, field in zip(row, schema)], schema=schema)

        for batch in source:
            for at in range(0, batch.num_rows, 500):  # so many texts' ids in memory at a time
                part = batch.slice(at, 500)
                texts = [text or b"" for text in part.column("text").cast(pa.binary()).to_pylist()]
                shard = part.column("shard")[0].as_py() if shard < 0 else shard
                with uncollected():
                    encoded = encoder.texts(texts)
                for name, ids in zip(part.column("doc_id").to_pylist(), encoded):
                    held.append(ids + end)
                    names.append(name)
                    size += len(ids) // 4 + 1
                    if size >= CHUNK:
                        yield out()
        if held:
            yield out()

    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    ranged.withColumn("shard", F.spark_partition_id()).mapInArrow(chunks, CHUNKS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written folder with their place among all ids: doc_id, start, n_tokens, ids (little-endian bytes).

    Starts are sums over chunks: one narrow row per chunk, first within the shard, then over the shards.
    """
    ship(spark)
    chunks = spark.read.schema(CHUNKS).parquet(path)
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))

    def documents(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for row in batch.to_pylist():
                ids = unpack(row["bytes"], row["blocks"], row["n_ids"], row["planes"]).tobytes()
                ends = np.cumsum([0, *row["lengths"]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(row["doc_ids"]), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(ends[:-1] + row["first"], pa.int64()),
                     pa.array(row["lengths"], pa.int64()), pa.array([ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:])], pa.binary())],
                    ["shard", "doc_id", "start", "n_tokens", "ids"],
                )

    read = chunks.mapInArrow(documents, "shard int, doc_id long, start long, n_tokens long, ids binary")
    # One row per task that wrote: small whatever the input.
    return read.join(F.broadcast(offsets), "shard").select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1, planes: str = "bytes") -> DataFrame:
    """Writes the documents' ids and returns what the files hold."""
    path = shared_dir(docs.sparkSession, "ids")
    write_ids(docs, path, vocabulary, end_id, planes)
    return read_ids(docs.sparkSession, path)
