"""Ingestion control: configuration, run log, errors.

The log is append-only: starting, completing and failing add events, and the
state of a (run, table) is its newest event. All functions work on sets of
runs, so one run is simply a one-row request.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.config import APPEND_WATERMARK, CHANGE_TRACKING
from tesora.operators.skew import salted_lookup

STARTED, SUCCEEDED, FAILED, SKIPPED = "STARTED", "SUCCEEDED", "FAILED", "SKIPPED"
RUN_KEYS = ("pipeline_run_id", "source_table")

CONFIG_SCHEMA = (
    "source_schema string, source_table string, load_strategy string, primary_key_column string, "
    "watermark_column string, last_change_version bigint, last_watermark_value bigint, "
    "initial_load_completed boolean, is_active boolean, updated_at_utc timestamp"
)
LOG_SCHEMA = (
    "pipeline_run_id string, batch_id string, source_table string, seq bigint, status string, "
    "event_at_utc timestamp, rows_read bigint, rows_copied bigint, bytes_written bigint, "
    "duration_seconds int, output_path string, error_message string, new_watermark bigint"
)
ERROR_SCHEMA = (
    "pipeline_run_id string, batch_id string, source_table string, activity_name string, "
    "error_code string, error_message string, error_details string, occurred_at_utc timestamp"
)


class ControlError(RuntimeError):
    pass


def active_specs(config: DataFrame) -> DataFrame:
    return config.where("is_active").drop("is_active", "updated_at_utc").orderBy("source_table")


def upsert_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str], defaults: dict[str, object]
) -> DataFrame:
    """Insert or update by key: matched rows take ``update`` columns from the source
    and keep the rest; new rows take ``defaults`` for columns the source lacks."""
    t, s = target.alias("t"), source.withColumn("_incoming", F.lit(True)).alias("s")
    matched = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    incoming = F.col("s._incoming").isNotNull()
    known = F.col(f"t.{keys[0]}").isNotNull()

    def merged(name: str):
        old = F.col(f"t.{name}")
        if name in keys:
            return F.coalesce(old, F.col(f"s.{name}")).alias(name)
        if name in update:
            return F.when(incoming, F.col(f"s.{name}")).otherwise(old).alias(name)
        return F.when(known, old).otherwise(F.lit(defaults.get(name))).alias(name)

    return matched.select(*[merged(name) for name in target.columns])


def upsert_config(config: DataFrame, incoming: DataFrame, as_of: datetime) -> DataFrame:
    """Merge configuration rows: strategy and key columns are reset and the table
    reactivated; progress is kept for known tables and starts empty for new ones."""
    return upsert_by_key(
        config,
        incoming.withColumns({"is_active": F.lit(True), "updated_at_utc": F.lit(as_of).cast("timestamp")}),
        keys=["source_schema", "source_table"],
        update=["load_strategy", "primary_key_column", "watermark_column", "is_active", "updated_at_utc"],
        defaults={"initial_load_completed": False},
    )


def start_runs(log: DataFrame, requests: DataFrame) -> DataFrame:
    """STARTED events for requested (run, table) pairs the log does not know yet.

    Repeated requests are reduced to the first one before the log is consulted.
    """
    first = requests.groupBy(*RUN_KEYS).agg(
        F.min_by(F.struct("batch_id", "seq", "event_at_utc"), F.struct("event_at_utc", "seq")).alias("_first")
    )
    fresh = first.join(log.select(*RUN_KEYS).distinct(), list(RUN_KEYS), "left_anti")
    return fresh.select(
        *RUN_KEYS, "_first.batch_id", "_first.seq", F.lit(STARTED).alias("status"), "_first.event_at_utc"
    )


def latest_state(events: DataFrame, keys: Sequence[str] = RUN_KEYS, order: str = "seq") -> DataFrame:
    """The newest event per key: an aggregate, so it shrinks before the shuffle."""
    rest = [c for c in events.columns if c not in keys]
    newest = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_newest"))
    return newest.select(*keys, *[F.col("_newest")[c].alias(c) for c in rest])


def without_start(log: DataFrame, finished: DataFrame, buckets: int = 8) -> DataFrame:
    """Completions of (run, table) pairs the log never saw; must be empty."""
    return salted_lookup(finished, log.select(*RUN_KEYS).distinct(), RUN_KEYS, ["seq"], buckets, how="left_anti")


def assert_started(log: DataFrame, finished: DataFrame) -> None:
    if not without_start(log, finished).isEmpty():
        raise ControlError("no STARTED entry for a completed table and run")


def complete_runs(log: DataFrame, completions: DataFrame, buckets: int = 8) -> DataFrame:
    """SUCCEEDED events, with their measures and no error, for pairs in the log."""
    known = salted_lookup(completions, log.select(*RUN_KEYS).distinct(), RUN_KEYS, ["seq"], buckets, how="left_semi")
    return known.select(
        *RUN_KEYS, "batch_id", "seq", F.lit(SUCCEEDED).alias("status"), "event_at_utc", "rows_read", "rows_copied",
        "bytes_written", "duration_seconds", "output_path", F.lit(None).cast("string").alias("error_message"),
    )


def advance_progress(config: DataFrame, completions: DataFrame, as_of: datetime) -> DataFrame:
    """Configuration after completions: the newest bound of each active table
    becomes its change version or its water mark, as its strategy says."""
    bounds = completions.groupBy("source_table").agg(F.max_by("new_watermark", "seq").alias("_bound"))
    joined = config.join(bounds, "source_table", "left")
    moved = F.col("is_active") & F.col("_bound").isNotNull()

    def bound_for(strategy: str, column: str):
        return F.when(moved & (F.col("load_strategy") == strategy), F.col("_bound")).otherwise(F.col(column))

    return joined.withColumns(
        {
            "last_change_version": bound_for(CHANGE_TRACKING, "last_change_version"),
            "last_watermark_value": bound_for(APPEND_WATERMARK, "last_watermark_value"),
            "initial_load_completed": F.col("initial_load_completed") | moved,
            "updated_at_utc": F.when(moved, F.lit(as_of).cast("timestamp")).otherwise(F.col("updated_at_utc")),
        }
    ).select(*config.columns)


def progress(config: DataFrame, log: DataFrame) -> DataFrame:
    """Configuration with the progress that the log proves: the newest SUCCEEDED bound of each table, at its event's time.

    Nothing else moves progress, so logging a success is one step, and a configuration that a caller has kept from
    earlier cannot turn it back. What the configuration itself says holds only for tables without a logged success.
    """
    done = log.where((F.col("status") == SUCCEEDED) & F.col("new_watermark").isNotNull())
    newest = done.groupBy("source_table").agg(
        F.max_by("new_watermark", "seq").alias("new_watermark"), F.max("seq").alias("seq"), F.max_by("event_at_utc", "seq").alias("_at")
    )
    moved = advance_progress(config, newest, None)
    return (
        moved.join(newest.select("source_table", "_at"), "source_table", "left")
        .withColumn("updated_at_utc", F.coalesce("updated_at_utc", "_at"))
        .select(*config.columns)
    )


def fail_runs(failures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(FAILED log events, error rows). Progress is not touched, so a repeated
    run extracts the same rows again."""
    events = failures.select(
        *RUN_KEYS, "batch_id", "seq", F.lit(FAILED).alias("status"), "event_at_utc", "error_message"
    )
    errors = failures.select(
        *RUN_KEYS, "batch_id", "activity_name", "error_code", "error_message", "error_details",
        F.col("event_at_utc").alias("occurred_at_utc"),
    )
    return events, errors
