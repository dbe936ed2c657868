"""Operator 5: token counts by heap-and-linked-list byte-pair merging; no identifiers are made.

A pre-token starts as its symbols in a linked list. The heap holds adjacent
pairs that have a merge rank; the lowest rank, leftmost first, is popped and
merged as long as the pair still stands. The count is symbols minus merges.

The vocabulary file fixes the rest: canonical composition, lower case,
pre-tokens, bytes as symbols, an end mark on the last one, and special strings
that count one token. Composition and pre-tokens never cross ASCII white space,
so a text's count is the sum over its words, and each worker process keeps the
counts of words it has met, up to ``CACHE`` of them.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.llm.common import ship

CACHE = 500_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable Latin-1 ones stand for themselves, the others follow from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


_COMMON = regex.compile(r"[\x00-\u04ff]*")
_STANDS = {"L": "é", "N": "²", "Z": "\xa0"}


def stand_in(char: str) -> str:
    """A character of the same class below U+0500, by the standard library's Unicode data."""
    return char if char < "\u0500" else _STANDS.get(unicodedata.category(char)[0], "¡")


def pre_tokens(pattern: regex.Pattern, text: str) -> list[str]:
    """Matches of a pattern that names letters, numbers and white space by class only."""
    if _COMMON.fullmatch(text):
        return pattern.findall(text)
    return [text[slice(*m.span())] for m in pattern.finditer("".join(map(stand_in, text)))]


def merges_to(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens that are left of a pre-token's symbols."""
    n = left = len(symbols)
    parts: list[str | None] = list(symbols)
    heap = [(rank, i) for i in range(n - 1) if (rank := ranks.get((parts[i], parts[i + 1]))) is not None]
    heapq.heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
            continue  # one of the two has been merged since
        parts[i] += parts[j]
        parts[j] = None
        left -= 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get((parts[i], parts[k]))) is not None:
                heapq.heappush(heap, (rank, i))
        if (k := before[i]) >= 0 and (rank := ranks.get((parts[k], parts[i]))) is not None:
            heapq.heappush(heap, (rank, k))
    return left


class Counts(dict):
    """Token counts of words (bytes), filled as they are asked for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.end, self.symbols = model["end_of_word_suffix"] or "", byte_symbols()
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.pieces: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        n = self.pieces.get(piece)
        if n is None:
            symbols = [self.symbols[b] for b in piece.encode()]
            symbols[-1] += self.end
            n = self.pieces[piece] = merges_to(symbols, self.ranks)
        return n

    def plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        # Letter by letter where a letter's lower case would depend on its place.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return sum(map(self.piece, pre_tokens(self.pattern, text)))

    def __missing__(self, word: bytes) -> int:
        text = word.decode()
        if self.special is None or not (marks := self.special.findall(text)):
            n = self.plain(text)
        else:
            n = len(marks) + sum(map(self.plain, self.special.split(text)))
        self[word] = n
        return n

    def text(self, text: bytes) -> int:
        n = sum(map(self.__getitem__, text.split()))  # bytes split at ASCII white space only
        if len(self) > CACHE:
            self.clear()
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        return n


_kept: dict[str, Counts] = {}


def counts_of(path: str) -> Counts:
    if path not in _kept:
        _kept[path] = Counts(path)
    return _kept[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. ``vocabulary`` is a path that each worker can open.

    A null or empty text has no bytes and no tokens; repeated rows stay repeated; no row of input, none of output.
    """
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counts_of(vocabulary)
        for batch in source:
            texts = [text or b"" for text in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(map(counts.text, texts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        batches, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
