"""What the operators share: words, intermediate tables, shipping of the package.

Conventions of every operator here: the input may carry any further columns;
they are ignored, and a further column that has the name of a result column
does not reach the result. A null text counts as the empty text.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but ASCII white space, in Java's and Python's notation alike.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def text_of(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(column: str | Column = "text") -> Column:
    return F.regexp_extract_all(text_of(column), F.lit(WORD), F.lit(0))


def n_words_of(column: str | Column = "text") -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def in_parts(source: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in slices whose binary ``column`` has ``limit`` bytes or a single row: few texts become Python objects at once."""
    for batch in source:
        ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors reach, under ``spark.checkpoint.dir``.

    Where the setting is absent, as in tests on one machine, a folder of this machine takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tesora-llm-")
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table and reads it back: cuts lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives this package to Python workers, once per application, wherever the session was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tesora-ship-"), "tesora_workers.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)
