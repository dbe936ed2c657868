"""Operator 4: document quality by a regularised quadratic discriminant.

Every whole text gives ``FEATURES`` statistics, transformed to be roughly
normal. Labelled rows give each class's count, sums and sums of products, added
up by Spark; from these follow a mean and a covariance per class. A class's
covariance is shrunk towards the pooled one and towards a multiple of the
identity, and kept as its Cholesky factor. A score is the logistic function of
the difference of the two log-densities, which are Mahalanobis distances found
by solving against the factors, plus the classes' log shares.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.llm.common import ship, stored

FEATURES = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "high_bytes", "sentence_marks", "other_marks",
    "distinct_words", "distinct_lines", "marks_in_words", "spaces",
)
# Below these counts a share says little: it is drawn to the middle by so many imagined bytes, words or lines.
_WEIGHT = 2.0


def _byte_classes() -> np.ndarray:
    """Class of each byte: 0 other marks, 1 upper, 2 lower, 3 digit, 4 white space, 5 above ASCII, 6 marks of plain sentences."""
    kinds = np.zeros(256, np.intp)
    for first, last, kind in ((65, 90, 1), (97, 122, 2), (48, 57, 3), (9, 13, 4), (32, 32, 4), (128, 255, 5)):
        kinds[first : last + 1] = kind
    kinds[[ord(c) for c in ".,;:'\"-?()"]] = 6
    return kinds


KINDS = _byte_classes()
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"-?()")


def _share(part: float, whole: float) -> float:
    """Log-odds of a share, finite for empty texts."""
    return float(np.log((part + 0.5) / (max(whole - part, 0.0) + 0.5 + _WEIGHT)))


def statistics(text: bytes) -> list[float]:
    n = len(text)
    held = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    other, upper, lower, digit, space, high, plain = np.bincount(KINDS, held, minlength=7).tolist()
    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    letters = upper + lower + high
    marked = len(words) - len(text.translate(None, _MARKS).split()) if other else 0  # words of marks only
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(np.log1p((n - space) / (len(words) + 1))),
        _share(upper, letters),
        _share(digit, n),
        _share(high, n),
        _share(plain, n),
        _share(other, n),
        _share(len(set(words)), len(words)),
        _share(len(set(lines)), len(lines)),
        _share(marked, len(words)),
        _share(space, n),
    ]


def featurize(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of the whole text; a null text counts as empty."""
    ship(docs.sparkSession)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            x = [statistics(text or b"") for text in texts]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        batches, "doc_id long, x array<double>"
    )


def held_out(column: str = "doc_id"):
    """True for the fifth of the rows that no model learns from; a null doc_id is one of them."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@dataclass(frozen=True)
class Discriminant:
    mean: np.ndarray  # of all rows learnt from
    scale: np.ndarray
    centres: np.ndarray  # a row for each class, of scaled statistics
    factors: np.ndarray  # Cholesky factors of the shrunk covariances
    offsets: np.ndarray  # log share minus half the log-determinant
    sharpness: float  # below 1, densities of dependent statistics count less than their product

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row."""
        z = (x - self.mean) / self.scale
        parts = [
            self.offsets[k] - 0.5 * np.square(np.linalg.solve(self.factors[k], (z - self.centres[k]).T)).sum(axis=0) for k in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(self.sharpness * (parts[0] - parts[1]), -50, 50)))


def fit(n: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float = 0.6, ridge: float = 0.01, sharpness: float = 1.0) -> Discriminant:
    """From class counts, sums and sums of products. A class without rows gets the pooled figures and the share of half a row."""
    d = sums.shape[1]
    total = max(n.sum(), 1)
    mean = sums.sum(axis=0) / total
    scatter = products - np.einsum("ki,kj->kij", sums, sums) / np.maximum(n, 1)[:, None, None]
    within = scatter.sum(axis=0) / total
    overall = products.sum(axis=0) / total - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(overall), 1e-12)) if n.sum() else np.ones(d)
    unit = np.outer(scale, scale)
    within = within / unit if n.sum() else np.eye(d)
    centres, factors, offsets = [], [], []
    for k in (0, 1):
        own = scatter[k] / max(n[k] - 1, 1) / unit if n[k] > 1 else within
        shrunk = (1 - pooled) * own + pooled * within
        shrunk = (1 - ridge) * shrunk + ridge * max(np.trace(shrunk) / d, 1e-6) * np.eye(d)
        factors.append(np.linalg.cholesky(shrunk))
        centres.append((sums[k] / n[k] - mean) / scale if n[k] else np.zeros(d))
        offsets.append(np.log((n[k] + 0.5) / (n.sum() + 1)) - np.log(np.diag(factors[-1])).sum())
    return Discriminant(mean, scale, np.array(centres), np.array(factors), np.array(offsets), sharpness)


def learn(features: DataFrame, labels: DataFrame, **settings: float) -> Discriminant:
    """Learns from all rows with quality 0 or 1 that are not held out; a document labelled twice counts twice.

    Each task adds up its own rows; what is summed over tasks is ``d * d + d + 1`` figures for each class.
    """
    d = len(FEATURES)
    marked = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).select("doc_id", F.col("quality").cast("int").alias("k"))

    def sums(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 + d + d * d))
        for batch in source:
            k = batch.column("k").to_numpy()
            x = np.asarray(batch.column("x").flatten()).reshape(-1, d)
            for c in (0, 1):
                y = x[k == c]
                held[c] += np.concatenate([[len(y)], y.sum(axis=0), (y.T @ y).ravel()])
        size = held.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], size), pa.int32()), pa.array(np.tile(np.arange(size), 2), pa.int32()), pa.array(held.ravel())],
            ["k", "i", "v"],
        )

    rows = features.join(marked, "doc_id").select("k", "x").mapInArrow(sums, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v"))
    table = np.zeros((2, 1 + d + d * d))
    for row in rows.collect():
        table[row.k, row.i] = row.v
    return fit(table[:, 0], table[:, 1 : 1 + d], table[:, 1 + d :].reshape(2, d, d), **settings)


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score (0 to 1, to nine digits so that the order of additions does not show)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.round(model.scores(x), 9))], ["doc_id", "score"])

    return features.select("doc_id", "x").mapInArrow(batches, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``, by a model learnt from ``labels``.

    Only the text makes a score: equal texts have equal scores. Null labels and labels of absent documents teach
    nothing; without any, every score is 0.5. Repeated rows stay repeated; no rows give none.
    """
    features = stored(featurize(docs), "quality")
    model = learn(features, labels, **settings)
    return score(features, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **settings: float) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of ``threshold`` or more. Rows are scored where they are read: no join moves a text."""
    model = learn(stored(featurize(docs), "quality"), labels, **settings)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = [statistics(text or b"") for text in batch.column("text").cast(pa.binary()).to_pylist()]
            if x:
                yield batch.filter(pa.array(np.round(model.scores(np.array(x)), 9) >= threshold))

    return docs.mapInArrow(batches, docs.schema)
