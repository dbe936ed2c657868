"""Sinks: appended rows, exports with a manifest, relational loads. Published layers are in ``snapshots``."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tesora.config import LOAD_ORDER, SPECS, TableSpec
from tesora.session import SHUFFLES_GO, settings

NAMESPACES = {
    "ctl": "Ingestion configuration, run log and errors",
    "bronze": "Immutable source files",
    "silver": "Cleansed and screened tables",
    "quality": "Quarantine and run metrics",
    "gold": "Dimensions, facts, marts and KPIs",
}


class PublishError(RuntimeError):
    pass


def ensure_namespaces(spark: SparkSession, root: str, prefix: str = "") -> None:
    for name, comment in NAMESPACES.items():
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {prefix}{name} COMMENT '{comment}' LOCATION '{root.rstrip('/')}/{name}'"
        )


def require_tables(spark: SparkSession, schema: str, names: Sequence[str]) -> None:
    missing = [name for name in names if not spark.catalog.tableExists(f"{schema}.{name}")]
    if missing:
        raise PublishError(f"missing {schema} tables: {', '.join(missing)}")


def kept_rows(spark: SparkSession, root: str, schema: str, table: str, ddl: str) -> DataFrame:
    """Rows appended so far under a root, none where nothing was appended yet."""
    try:
        return spark.read.schema(ddl).parquet(f"{root.rstrip('/')}/{schema}/{table}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def append_rows(df: DataFrame, root: str, schema: str, table: str, columns: Sequence[str], register: bool = True, prefix: str = "") -> None:
    """Append in a fixed column order, and make sure the table is known."""
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{schema}/{table}"
    df.select(*columns).write.mode("append").parquet(path)
    if register:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{schema}.{table} USING parquet LOCATION '{path}'")
        spark.catalog.refreshTable(f"{prefix}{schema}.{table}")


def export_tables(
    frames: Mapping[str, DataFrame],
    out: str,
    formats: Sequence[str] = ("csv", "parquet"),
    rows_per_file: int = 1_000_000,
) -> None:
    """Each table as CSV (header, comma, ISO dates) and/or snappy Parquet, in files of bounded size.

    A table is computed once: its CSV is made from its Parquet files where both are asked for, so the two hold the same rows.
    """
    for name, df in frames.items():
        held = df
        for kind in sorted(formats, key=lambda kind: kind != "parquet"):
            path = f"{out.rstrip('/')}/{kind}/{name}"
            with settings(df.sparkSession, SHUFFLES_GO):
                target = held.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
                if kind == "csv":
                    target.option("header", True).option("encoding", "UTF-8").option("dateFormat", "yyyy-MM-dd").csv(path)
                elif kind == "parquet":
                    target.option("compression", "snappy").parquet(path)
                    held = df.sparkSession.read.schema(df.schema).parquet(path)
                else:
                    raise ValueError(f"unsupported format: {kind}")


def manifest(
    spark: SparkSession, columns: Mapping[str, Sequence[str]], out: str, formats: Sequence[str] = ("csv", "parquet")
) -> DataFrame:
    """One row per exported file: rows, columns and SHA-256 of its bytes.

    A digest needs the bytes of its file in one task; exports bound the rows of
    a file for that reason.
    """
    parts = []
    for name, names in columns.items():
        for kind in formats:
            folder = f"{out.rstrip('/')}/{kind}/{name}"
            reader = spark.read.option("header", True) if kind == "csv" else spark.read
            rows = (
                getattr(reader, kind)(folder)
                .groupBy(F.col("_metadata.file_path").alias("path"))
                .agg(F.count("*").alias("rows"))
            )
            digests = (
                spark.read.format("binaryFile")
                .option("pathGlobFilter", f"*.{kind}")
                .load(folder)
                .select(F.col("_metadata.file_path").alias("path"), F.sha2("content", 256).alias("sha256"))
            )
            parts.append(
                digests.join(rows, "path", "left").select(
                    F.lit(name).alias("table_name"),
                    F.lit(kind).alias("format"),
                    "path",
                    F.coalesce("rows", F.lit(0)).alias("rows"),
                    F.lit(",".join(names)).alias("columns"),
                    "sha256",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def normalize(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns in table order and type; a NaN becomes null."""

    def clean(name: str):
        column = F.col(name)
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            column = F.when(~F.isnan(column), column)
        return column.cast(spec.types[name]).alias(name)

    return df.select(*[clean(name) for name in spec.columns])


def load_tables(
    frames: Mapping[str, DataFrame],
    write: Callable[[str, DataFrame], None],
    count: Callable[[str], int],
    clear: Callable[[str], None] | None = None,
    order: Sequence[str] = LOAD_ORDER,
) -> dict[str, int]:
    """Load parents before children, optionally clearing children first, and
    compare what the target then holds with what was sent."""
    names = [name for name in order if name in frames]
    if clear is not None:
        for name in reversed(names):
            clear(name)
    for name in names:
        write(name, frames[name])
    sent = {name: frames[name].count() for name in names}
    held = {name: count(name) for name in names}
    if sent != held:
        raise PublishError(f"loaded row counts differ: sent {sent}, held {held}")
    return held


def jdbc_writer(url: str, batch_size: int = 5_000, partitions: int = 8, **properties: str):
    """A ``write`` for :func:`load_tables`: batched inserts over few connections."""

    def write(name: str, df: DataFrame) -> None:
        options = {"url": url, "dbtable": name, "batchsize": str(batch_size), "numPartitions": str(partitions)}
        normalize(df, SPECS[name]).write.format("jdbc").options(**options, **properties).mode("append").save()

    return write


def load_jdbc(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    url: str,
    replace: bool = False,
    batch_size: int = 5_000,
    **properties: str,
) -> dict[str, int]:
    """:func:`load_tables` into a relational database, rows cleared first on request."""

    def connected(reader_or_writer, name: str):
        return reader_or_writer.format("jdbc").options(url=url, dbtable=name, **properties)

    def count(name: str) -> int:
        return connected(spark.read, name).load().agg(F.count("*")).first()[0]

    def clear(name: str) -> None:
        nothing = spark.createDataFrame([], SPECS[name].ddl)
        connected(nothing.write, name).option("truncate", "true").mode("overwrite").save()

    write = jdbc_writer(url, batch_size, **properties)
    return load_tables(frames, write, count, clear if replace else None)
