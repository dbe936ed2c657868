"""Failure alerts over the run log; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failure_alerts(
    events: DataFrame,
    time: str = "event_at_utc",
    size: str = "5 minutes",
    slide: str = "1 minute",
    threshold: int = 0,
    status: str = "FAILED",
    lateness: str | None = None,
) -> DataFrame:
    """Windows in which more than ``threshold`` runs ended in ``status``.

    A stream has to say how late an event may come (``lateness``): its window
    closes then, and events that come later are not counted. A batch counts all.
    """
    failed = events.where(F.col("status") == status)
    if events.isStreaming:
        if lateness is None:
            raise ValueError("a stream of events needs a lateness")
        failed = failed.withWatermark(time, lateness)
    return (
        failed.groupBy(F.window(time, size, slide))
        .agg(F.count("*").alias("failed_runs"))
        .where(F.col("failed_runs") > threshold)
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "failed_runs"
        )
    )
