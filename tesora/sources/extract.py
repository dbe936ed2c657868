"""Incremental extraction: full, by high-water mark, by change feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader
from pyspark.sql import functions as F

from tesora.config import APPEND_WATERMARK, CHANGE_TRACKING, TableSpec


class ExtractError(RuntimeError):
    """An extract that cannot be planned; ``code`` tells why."""

    def __init__(self, code: str, message: str) -> None:
        super().__init__(f"{code}: {message}")
        self.code = code


@dataclass(frozen=True)
class LoadState:
    """Progress of one table, as its configuration row keeps it."""

    strategy: str
    is_active: bool = True
    initial_load_completed: bool = False
    last_change_version: int | None = None
    last_watermark_value: int | None = None


@dataclass(frozen=True)
class ChangeFeed:
    """Changes of one table: (key, version, op), and the feed's version range."""

    changes: DataFrame
    current_version: int
    min_valid_version: int


@dataclass(frozen=True)
class Extract:
    rows: DataFrame
    bound: int


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; with a numeric key the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if driver:
        options["driver"] = driver
    if column and bounds and partitions > 1:
        options |= {
            "partitionColumn": column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def full_extract(reader: DataFrameReader, spec: TableSpec, **options: str) -> DataFrame:
    """The whole table through a configured reader (JDBC or files)."""
    df = reader.options(**options).load() if options else reader.load()
    return df.select(*spec.columns)


def high_water_mark(df: DataFrame, column: str) -> int:
    """The largest key now present, 0 when empty: one number, read first."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint")).first()[0]


def watermark_delta(df: DataFrame, column: str, last: int | None, initial: bool) -> Extract:
    """Rows above the last mark, up to the mark taken before reading."""
    bound = high_water_mark(df, column)
    upto = F.col(column) <= bound
    wanted = upto if initial else (F.col(column) > (last or 0)) & upto
    return Extract(df.where(wanted), bound)


def change_feed_delta(df: DataFrame, changes: DataFrame, key: str, last: int, bound: int) -> DataFrame:
    """Current rows of keys whose net change since ``last`` is an insert or update.

    The net change is the newest one; if that lies beyond ``bound`` the key
    waits for the next run. Deletes are not propagated.
    """
    net = (
        changes.where(F.col("version") > last)
        .groupBy(key)
        .agg(F.max("version").alias("_version"), F.max_by("op", "version").alias("_op"))
        .where((F.col("_version") <= bound) & F.col("_op").isin("I", "U"))
    )
    return df.join(net.select(key), key, "left_semi")


def assert_feed_valid(last: int | None, min_valid: int) -> None:
    if last is None or last < min_valid:
        raise ExtractError("FEED_EXPIRED", f"change feed starts at {min_valid}, last read {last}: full reload required")


def plan_extract(
    spec: TableSpec,
    state: LoadState | None,
    source: Callable[[], DataFrame | None],
    feed: ChangeFeed | None = None,
) -> Extract:
    """Pick the extract a table's configuration asks for."""
    if state is None or not state.is_active:
        raise ExtractError("NO_ACTIVE_CONFIG", f"{spec.name} has no active configuration")
    df = source()
    if df is None:
        raise ExtractError("SOURCE_MISSING", f"{spec.name} does not exist in the source")

    if state.strategy == APPEND_WATERMARK:
        if spec.watermark_column is None:
            raise ExtractError("APPEND_NOT_ENABLED", f"{spec.name} has no append-only key")
        return watermark_delta(
            df, spec.watermark_column, state.last_watermark_value, not state.initial_load_completed
        )
    if state.strategy == CHANGE_TRACKING:
        bound = feed.current_version if feed else 0
        if not state.initial_load_completed:
            return Extract(df, bound)
        assert_feed_valid(state.last_change_version, feed.min_valid_version if feed else 0)
        if feed is None:
            raise ExtractError("FEED_MISSING", f"{spec.name} has no change feed")
        return Extract(change_feed_delta(df, feed.changes, spec.key, state.last_change_version, bound), bound)
    raise ExtractError("UNKNOWN_STRATEGY", f"{state.strategy} is not supported")
