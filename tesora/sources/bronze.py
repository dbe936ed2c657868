"""Landing of extracts as immutable, date-partitioned Parquet, and its reading."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tesora.config import LakeConfig, RunContext, TableSpec
from tesora.sources.snapshots import Commit, Layer, create_once, folders

PARTITIONS = ("year", "month", "day", "run", "attempt")
TECHNICAL = "_ingestion_timestamp_utc timestamp, _source_system string, _batch_id string"


class ClosedDay(RuntimeError):
    """A landing in a day whose files have been compacted: no reader would see it."""


def with_technical_columns(df: DataFrame, source_system: str, run: RunContext) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp_utc": F.lit(run.as_of).cast("timestamp"),
            "_source_system": F.lit(source_system),
            "_batch_id": F.lit(run.batch),
        }
    )


def landing_path(root: str, spec: TableSpec, run: RunContext, attempt: str) -> str:
    day = run.as_of
    return (
        f"{root.rstrip('/')}/{spec.name.lower()}"
        f"/year={day:%Y}/month={day:%m}/day={day:%d}/run={run.run_id}/attempt={attempt}"
    )


def land_bronze(
    df: DataFrame, root: str, spec: TableSpec, cfg: LakeConfig, run: RunContext, attempt: str | None = None
) -> str:
    """Write one extract under its own date, run and attempt folder; return the path.

    A run has a single date, so the folder is named instead of computed per
    row and the write needs no shuffle. Bronze only grows: an attempt never
    writes over another one, and rows that a repeated attempt lands again are
    absorbed by deduplication. Values take the table's types. An empty extract is written too: its schema is
    the record that the run happened.
    """
    if (closed := closed_until(df.sparkSession, root, spec)) and run.as_of.date() < closed:
        raise ClosedDay(f"{spec.name}: days before {closed} are compacted")
    path = landing_path(root, spec, run, attempt or uuid.uuid4().hex)
    typed = df.select(*[F.col(name).cast(spec.types[name]).alias(name) if name in spec.types else F.col(name) for name in df.columns])
    with_technical_columns(typed, cfg.source_system, run).write.mode("errorifexists").parquet(path)
    return path


def read_bronze(
    spark: SparkSession, root: str, spec: TableSpec, since: date | None = None, until: date | None = None
) -> DataFrame:
    """All landed files of a table, with file name and row position.

    The columns are the table's own, not guessed from a file. Folder discovery
    stays on, so a date range prunes whole folders; the folder columns
    themselves are not part of the table.
    """
    folder = f"{root.rstrip('/')}/{spec.name.lower()}"
    landed = spark.read.schema(f"{spec.ddl}, {TECHNICAL}, year int, month int, day int").option("basePath", folder).parquet(folder)
    folder_day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    if since is not None:
        landed = landed.where(folder_day >= F.lit(since))
    if until is not None:
        landed = landed.where(folder_day <= F.lit(until))
    return landed.select(
        *[c for c in landed.columns if c not in PARTITIONS and c != "_ingestion_timestamp_utc"],
        F.col("_ingestion_timestamp_utc").cast("timestamp").alias("_ingestion_timestamp_utc"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.row_index").alias("_row_index"),
    )


# --- Compaction -------------------------------------------------------------
#
# Daily landings are small files. Whole past days are rewritten into few files, sorted by day and key, and an index keeps
# each file's smallest and largest day and key. Readers ask the index and open the files in range; of landings they list
# only days that are not compacted. Landed files stay as they are.


def _day(day: date) -> Column:
    return F.lit(day.isoformat()).cast("date")  # also the first day there is


def closed_until(spark: SparkSession, root: str, spec: TableSpec) -> date | None:
    """The first day that is open for landings; None if nothing was compacted. One listing, no job."""
    marks = folders(spark, f"{root.rstrip('/')}/_closed/{spec.name.lower()}")
    return date.fromisoformat(marks[-1].removeprefix("before=")) if marks else None


def _compactions(spark: SparkSession, root: str, spec: TableSpec) -> Layer:
    return Layer(spark, root, f"compacted_{spec.name.lower()}")


def compact(spark: SparkSession, root: str, spec: TableSpec, before: date, rows_per_file: int = 1_000_000) -> Commit | None:
    """Rewrites the landed days before a day that no run lands in any more; earlier compactions keep their files.

    The day is closed for landings first, then rows are copied with the names and positions they had, then the files and
    their index are published by one commit. A failure between these steps loses nothing: the days are still read as they
    landed, and a repetition goes on from the last commit. None if there is nothing to compact.
    """
    layer = _compactions(spark, root, spec)
    last = layer.newest()
    since = date.fromisoformat(last.version[:10]) if last else date.min
    days = [day for day in landed_days(spark, root, spec) if since <= day < before]
    if not days:
        return None
    create_once(spark, f"{root.rstrip('/')}/_closed/{spec.name.lower()}/before={before}/mark", "")
    rows = _read_days(spark, root, spec, days)
    target = f"{root.rstrip('/')}/_compacted/{spec.name.lower()}/{before}-{uuid.uuid4().hex}"
    files = max(1, -(-rows.count() // rows_per_file))
    order = ["_day", spec.key, "_source_file", "_row_index"]
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(f"{target}/data")
    held = spark.read.schema(rows.schema).parquet(f"{target}/data")
    index = held.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"),
        *[f(c).alias(f"{f.__name__}_{name}") for c, name in (("_day", "day"), (spec.key, "key")) for f in (F.min, F.max)],
        F.count_if(F.col(spec.key).isNull()).alias("null_keys"),
    )
    index.coalesce(1).write.parquet(f"{target}/index")
    tables = {name: (entry["path"], entry["rows"], entry["digest"]) for name, entry in (last.tables if last else {}).items()}
    tables[f"{since}..{before}"] = (f"{target}/index", held.count(), "")
    return layer.commit(f"{before}-{uuid.uuid4().hex}", str(before), tables, last.seq if last else 0)


def landed_days(spark: SparkSession, root: str, spec: TableSpec, since: date = date.min, until: date = date.max) -> list[date]:
    """Days with landings in a range. Folders of other years and months are not entered."""
    base, found = f"{root.rstrip('/')}/{spec.name.lower()}", []
    number = lambda name: int(name.split("=")[1])
    for year in folders(spark, base):
        if year.startswith("year=") and since.year <= number(year) <= until.year:
            for month in folders(spark, f"{base}/{year}"):
                if (since.year, since.month) <= (number(year), number(month)) <= (until.year, until.month):
                    days = (date(number(year), number(month), number(day)) for day in folders(spark, f"{base}/{year}/{month}"))
                    found += [day for day in days if since <= day <= until]
    return found


def _read_days(spark: SparkSession, root: str, spec: TableSpec, days: list[date]) -> DataFrame:
    base = f"{root.rstrip('/')}/{spec.name.lower()}"
    landed = spark.read.schema(f"{spec.ddl}, {TECHNICAL}, year int, month int, day int").option("basePath", base)
    return _shown(landed.parquet(*[f"{base}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]), F.make_date(F.col("year"), F.col("month"), F.col("day")))


def _shown(landed: DataFrame, day: Column) -> DataFrame:
    return landed.select(
        *[c for c in landed.columns if c not in PARTITIONS],
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.row_index").alias("_row_index"),
        day.alias("_day"),
    )


def read_compacted(
    spark: SparkSession, root: str, spec: TableSpec, since: date = date.min, until: date = date.max, keys: tuple[object, object] | None = None
) -> DataFrame:
    """The rows that :func:`read_bronze` gives for the days from ``since`` to ``until``, and for keys within ``keys`` if given.

    Only compacted files whose days and keys meet the ranges are opened, by one look into the index (a row for each file);
    of landings only days after the last compaction.
    """
    commit = _compactions(spark, root, spec).newest()
    horizon = date.fromisoformat(commit.version[:10]) if commit else date.min
    parts = []
    if commit:
        near = spark.read.parquet(*[held["path"] for held in commit.tables.values()]).where(
            (F.col("max_day") >= _day(since)) & (F.col("min_day") <= _day(until))
        )
        if keys:
            near = near.where((F.col("max_key") >= F.lit(keys[0])) & (F.col("min_key") <= F.lit(keys[1])))
        names = [row["file"] for row in near.select("file").collect()]
        if names:
            kind = f"{spec.ddl}, {TECHNICAL}, _source_file string, _row_index bigint, _day date"
            parts.append(spark.read.schema(kind).parquet(*names))
    if fresh := landed_days(spark, root, spec, max(since, horizon), until):
        parts.append(_read_days(spark, root, spec, fresh))
    if not parts:
        return spark.createDataFrame([], f"{spec.ddl}, {TECHNICAL}, _source_file string, _row_index bigint")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = rows.where(F.col("_day").between(_day(since), _day(until)))
    if keys:
        rows = rows.where(F.col(spec.key).between(F.lit(keys[0]), F.lit(keys[1])))
    return rows.drop("_day")
