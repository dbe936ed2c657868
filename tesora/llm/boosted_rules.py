"""Operator 11: quality rules by gradient-boosted trees over document statistics.

Every whole text gives integer counts, ``COUNTS``, and from them the
statistics of ``FEATURES``. A fixed base rule rejects short and repetitive
texts. The others are judged by boosted trees: each tree is grown on binned
statistics by second-order gains of the logistic loss. A statistic listed in
``MONOTONE`` may only lower (-1) or raise (+1) a score: a split against its
direction is not made, and the two sides of one made bound each other's leaves
by their middle value, all the way down. The finished trees are flattened into
numpy node arrays, and a batch of rows walks all trees at once, a level a step.

The trees are learnt on the driver from at most ``SAMPLE`` labelled rows, those
with the smallest hash of doc_id; counting and scoring read every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.llm.common import in_parts, ship, stored
from tesora.llm.quality import held_out

SAMPLE = 50_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeat_words", "distinct_words", "digits", "upper",
    "sentence_ends", "other_marks", "line_words", "high_bytes",
)
# More symbols, repeated lines or repeated words never make a document better.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeat_words": -1}

_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_ENDS = np.frombuffer(b".!?", np.uint8)
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-?!()#*$%&|<>"])


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of ``width`` words that occur twice or more in the text, the first occurrence included."""
    if len(words) <= width:
        return 0
    ids: dict[bytes, int] = {}
    own = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    code = own[: len(own) - width + 1]
    for i in range(1, width):  # codes stay below the number of words, so no product overflows
        _, code = np.unique(code * len(ids) + own[i : len(own) - width + 1 + i], return_inverse=True)
    again = np.flatnonzero(np.bincount(code)[code] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """(COUNTS, FEATURES) of a whole text in UTF-8."""
    words = text.split()  # bytes split at ASCII white space only
    lines = [line for line in text.split(b"\n") if line.strip()]
    held = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    blanks = int(held[9:14].sum() + held[32])
    chars = len(text) - blanks - int(held[128:192].sum())
    n, distinct = len(words), len(set(words))
    symbols, copies, again = int(held[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated_words(words)
    high, whole = int(held[192:].sum()), chars + 1
    counts = [n, chars, symbols, copies, again]
    return counts, [
        float(np.log1p(n)),
        chars / (n + 1),
        symbols / whole,
        copies / (len(lines) + 1),
        again / (n + 1),
        distinct / (n + 1),
        int(held[48:58].sum()) / whole,
        int(held[65:91].sum()) / whole,
        int(held[_ENDS].sum()) / (n + 1),
        int(held[_MARKS].sum()) / whole,
        float(np.log1p(n / (len(lines) + 1))),
        high / whole,
    ]


def count(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, and x, the statistics, of every row; a null text counts as empty."""
    ship(docs.sparkSession)
    schema = "doc_id long, " + "".join(f"{name} long, " for name in COUNTS) + "x array<double>"

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(source):
            found = [statistics(text or b"") for text in batch.column("text").to_pylist()]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c) for c in counts.T], pa.array([x for _, x in found], pa.list_(pa.float64()))],
                ["doc_id", *COUNTS, "x"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.mapInArrow(batches, schema).withColumn("base_failed", failed)


@dataclass(frozen=True)
class Trees:
    """All trees' nodes in arrays; a leaf is its own child, so every row may take ``depth`` steps."""

    prior: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-np.clip(self.prior + self.value[at].sum(axis=1), -50, 50)))


class _Nodes:
    def __init__(self) -> None:
        self.rows: list[list[float]] = []

    def add(self) -> int:
        self.rows.append([0, np.inf, len(self.rows), len(self.rows), 0.0])
        return len(self.rows) - 1


def _best_split(binned: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int, ridge: float, least: float, signs: np.ndarray, low: float, high: float):
    """(gain, feature, bin, left value, right value) of the best allowed split of a node's rows, or None."""
    d = binned.shape[1]
    place = (binned + np.arange(d) * bins).ravel()
    gs = np.bincount(place, np.repeat(g, d), d * bins).reshape(d, bins).cumsum(axis=1)
    hs = np.bincount(place, np.repeat(h, d), d * bins).reshape(d, bins).cumsum(axis=1)
    gl, hl, gr, hr = gs[:, :-1], hs[:, :-1], gs[:, -1:] - gs[:, :-1], hs[:, -1:] - hs[:, :-1]
    vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
    v = np.clip(-g.sum() / (h.sum() + ridge), low, high)

    def loss(value, g, h):
        return g * value + 0.5 * (h + ridge) * value * value

    gain = loss(v, g.sum(), h.sum()) - loss(vl, gl, hl) - loss(vr, gr, hr)
    gain[(hl < least) | (hr < least) | (signs[:, None] * (vr - vl) < 0)] = -np.inf
    best = int(np.argmax(gain))  # the first of equal ones
    f, b = divmod(best, bins - 1)
    return (gain[f, b], f, b, vl[f, b], vr[f, b]) if gain[f, b] > 1e-9 else None


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0,
    least: float = 1.0, monotone: dict[str, int] | None = None, names: tuple[str, ...] = FEATURES,
) -> Trees:
    """Boosted trees for labels 0 and 1. Without rows or with one class only there are no trees, just the classes' share."""
    monotone = MONOTONE if monotone is None else monotone
    signs = np.array([monotone.get(name, 0) for name in names])
    prior = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    nodes, roots = _Nodes(), []
    if 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(cuts, x.T)], axis=1)
        margin = np.full(len(y), prior)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            roots.append(nodes.add())
            work = [(roots[-1], np.arange(len(y)), depth, -np.inf, np.inf, None)]
            while work:
                node, rows, left_depth, low, high, value = work.pop()
                if value is None:
                    value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
                split = _best_split(binned[rows], g[rows], h[rows], bins, ridge, least, signs, low, high) if left_depth else None
                if split is None:
                    nodes.rows[node][4] = rate * value
                    margin[rows] += rate * value
                    continue
                _, f, b, vl, vr = split
                goes = binned[rows, f] <= b
                a, c = nodes.add(), nodes.add()
                nodes.rows[node][:4] = [f, cuts[f][b], a, c]
                middle, sign = (vl + vr) / 2, signs[f]
                work.append((a, rows[goes], left_depth - 1, middle if sign < 0 else low, middle if sign > 0 else high, float(vl)))
                work.append((c, rows[~goes], left_depth - 1, middle if sign > 0 else low, middle if sign < 0 else high, float(vr)))
    table = np.array(nodes.rows).reshape(-1, 5)
    f, _, a, c = table[:, :4].astype(object).T if len(table) else [[]] * 4
    as_index = lambda v: np.array(v, np.intp)
    return Trees(prior, as_index(roots), as_index(f), table[:, 1], as_index(a), as_index(c), table[:, 4], depth)


def learn(counted: DataFrame, labels: DataFrame, sample: int = SAMPLE, **settings) -> Trees:
    """Learns from labelled rows that are not held out: all of them up to ``sample``, else those with the smallest hash."""
    marked = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", F.col("quality").cast("int").alias("y"))
    order = [F.xxhash64("doc_id"), "doc_id", "y", "x"]
    rows = counted.select("doc_id", "x").join(marked, "doc_id").orderBy(*order).limit(sample).select("x", "y").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return fit(x, rows.column("y").to_numpy().astype(float), **settings)


def apply(counted: DataFrame, model: Trees, threshold: float = 0.3) -> DataFrame:
    """doc_id, the counts, base_failed, score (to nine digits) and kept."""
    passed = [name for name in counted.columns if name != "x"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            scores = pa.array(np.round(model.scores(x), 9))
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in passed], scores], [*passed, "score"])

    schema = ", ".join(f"{name} {kind}" for name, kind in counted.dtypes if name != "x") + ", score double"
    return counted.mapInArrow(batches, schema).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE, **settings) -> DataFrame:
    """doc_id, the counts, base_failed, score and kept of every row of ``docs``, by trees learnt from ``labels``.

    Only the text makes a score: equal texts are judged alike. Null and empty texts fail the base rule, as all short
    ones do. Null labels and labels of absent documents teach nothing; without any, the base rule alone decides.
    Repeated rows stay repeated; no rows give none; further columns are ignored.
    """
    counted = stored(count(docs), "statistics")
    return apply(counted, learn(counted, labels, sample, **settings), threshold)
