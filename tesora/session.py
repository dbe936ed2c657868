"""Session defaults. On a cluster the submit command decides size and master."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hash-shuffled facts are split by AQE even where that costs one more
    # exchange afterwards: a straggler costs more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Building a plan otherwise records a call site per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# For what is planned inside ``settings``: its shuffle files go when it has run, and not only once the JVM has collected its plan.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(app: str = "tesora", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``; only where
    that is unset (local tests) does a folder of this machine serve.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/tesora/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"tesora-{label}-")
