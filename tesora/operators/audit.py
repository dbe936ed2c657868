"""Integrity, reconciliation and idempotence audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesora.config import PERSONAL_COLUMNS, PROTECTED_ACCOUNT_COLUMN
from tesora.functions.columns import record_hash


class AuditError(RuntimeError):
    pass


# --- Keys -------------------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count; null is a key like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("cantidad")).where("cantidad > 1")


def duplicate_key_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: repeated keys, and rows beyond the first of each."""
    parts = [
        duplicate_keys(df, keys)
        .agg(
            F.count("*").alias("claves_duplicadas"),
            F.coalesce(F.sum(F.col("cantidad") - 1), F.lit(0)).alias("filas_excedentes"),
        )
        .select(F.lit(name).alias("tabla"), "claves_duplicadas", "filas_excedentes")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def assert_unique(df: DataFrame, keys: Sequence[str], name: str) -> None:
    if not duplicate_keys(df, keys).isEmpty():
        raise AuditError(f"{name} has duplicate keys: {', '.join(keys)}")


def assert_not_empty(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise AuditError(f"{name} is empty")


def assert_count(df: DataFrame, expected: int, name: str) -> None:
    found = df.count()
    if found != expected:
        raise AuditError(f"{name}: expected {expected} rows, found {found}")


def outside_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose value is present and not in the domain."""
    return df.where(~F.col(column).isin(*allowed))


def assert_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> None:
    if not outside_domain(df, column, allowed).isEmpty():
        raise AuditError(f"{column} holds values outside its domain")


# --- References -------------------------------------------------------------


@dataclass(frozen=True)
class Relation:
    """A foreign key of ``fact`` into ``dim``; ``name`` is how it is reported."""

    name: str
    fact: str
    fk: str
    dim: str
    pk: str


# The ten relations of the star and the names they report under.
STAR_RELATIONS = (
    Relation("movimientos_sin_cliente", "fact_movimientos", "cliente_key", "dim_cliente", "cliente_key"),
    Relation("movimientos_sin_producto", "fact_movimientos", "producto_key", "dim_producto", "producto_key"),
    Relation("movimientos_sin_fecha", "fact_movimientos", "fecha_key", "dim_fecha", "fecha_key"),
    Relation("obligaciones_sin_cliente", "fact_obligaciones", "cliente_key", "dim_cliente", "cliente_key"),
    Relation("obligaciones_sin_producto", "fact_obligaciones", "producto_key", "dim_producto", "producto_key"),
    Relation("obligaciones_sin_fecha_desembolso", "fact_obligaciones", "fecha_desembolso_key", "dim_fecha", "fecha_key"),
    Relation("obligaciones_sin_fecha_vencimiento", "fact_obligaciones", "fecha_venc_key", "dim_fecha", "fecha_key"),
    Relation("comisiones_sin_cliente", "fact_comisiones", "cliente_key", "dim_cliente", "cliente_key"),
    Relation("comisiones_sin_producto", "fact_comisiones", "producto_key", "dim_producto", "producto_key"),
    Relation("comisiones_sin_fecha", "fact_comisiones", "fecha_key", "dim_fecha", "fecha_key"),
)


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """(key, rows) for foreign keys without a dimension row; a null key is an orphan.

    Rows are counted per key before the join, so what is shuffled is one row
    per distinct key and a key with very many rows weighs no more than another.
    """
    counted = fact.groupBy(F.col(fk).alias("_fk")).agg(F.count("*").alias("filas"))
    known = dim.select(F.col(pk).alias("_pk"))
    return counted.join(known, F.col("_fk") == F.col("_pk"), "left_anti").select(F.col("_fk").alias(fk), "filas")


def orphan_totals(tables: Mapping[str, DataFrame], relations: Sequence[Relation] = STAR_RELATIONS) -> DataFrame:
    """One row, one orphan count per relation, reading each fact once.

    A fact row yields one (relation, key) pair per foreign key; pairs are
    counted before anything is shuffled, and one anti join against the
    dimensions' own pairs finds the orphans of all relations together.
    """
    pairs = []
    for name in dict.fromkeys(r.fact for r in relations):
        own = [
            F.struct(F.lit(r.name).alias("control"), F.col(r.fk).cast("string").alias("clave"))
            for r in relations
            if r.fact == name
        ]
        pairs.append(tables[name].select(F.inline(F.array(*own))))
    counted = reduce(DataFrame.unionByName, pairs).groupBy("control", "clave").agg(F.count("*").alias("filas"))

    known = []
    for dim, pk in dict.fromkeys((r.dim, r.pk) for r in relations):
        names = F.array(*[F.lit(r.name) for r in relations if (r.dim, r.pk) == (dim, pk)])
        known.append(tables[dim].select(F.explode(names).alias("control"), F.col(pk).cast("string").alias("clave")))
    missing = counted.join(reduce(DataFrame.unionByName, known), ["control", "clave"], "left_anti")

    def total(r: Relation) -> Column:
        return F.coalesce(F.sum(F.when(F.col("control") == r.name, F.col("filas"))), F.lit(0)).alias(r.name)

    return missing.agg(*[total(r) for r in relations])


def orphan_counts(tables: Mapping[str, DataFrame], relations: Sequence[Relation] = STAR_RELATIONS) -> DataFrame:
    """(control, inconsistencias) for every relation, those without orphans included."""
    totals = orphan_totals(tables, relations)
    return totals.unpivot([], [F.col(f"`{r.name}`") for r in relations], "control", "inconsistencias")


def assert_no_orphans(counts: DataFrame) -> None:
    bad = [row["control"] for row in counts.where("inconsistencias > 0").collect()]  # one row per relation
    if bad:
        raise AuditError(f"orphans in: {', '.join(sorted(bad))}")


# --- Reconciliation ---------------------------------------------------------


def reconcile(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Compare (control, valor) of both layers. Two null values agree; a control that only one layer has does not."""
    left = silver.select("control", F.col("valor").alias("valor_silver"), F.lit(True).alias("_left"))
    right = gold.select("control", F.col("valor").alias("valor_gold"), F.lit(True).alias("_right"))
    both = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    return left.join(right, "control", "full_outer").select(
        "control", "valor_silver", "valor_gold", (both & F.col("valor_silver").eqNullSafe(F.col("valor_gold"))).alias("resultado")
    )


def controls(values: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """(control, valor): one aggregate per named control."""
    parts = [df.agg(value.alias("valor")).select(F.lit(name).alias("control"), "valor") for name, (df, value) in values.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile_counts(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts, control by control."""
    rows = F.count("*")
    return reconcile(
        controls({f"conteo_{name}": (df, rows) for name, df in silver.items()}),
        controls({f"conteo_{name}": (df, rows) for name, df in gold.items()}),
    )


def reconcile_sums(
    silver: Mapping[str, tuple[DataFrame, str]], gold: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Exact decimal sums, control by control."""
    return reconcile(
        controls({name: (df, F.sum(column)) for name, (df, column) in silver.items()}),
        controls({name: (df, F.sum(column)) for name, (df, column) in gold.items()}),
    )


def assert_reconciled(result: DataFrame) -> None:
    bad = [row["control"] for row in result.where("NOT resultado").collect()]  # one row per control
    if bad:
        raise AuditError(f"layers disagree on: {', '.join(sorted(bad))}")


# --- Contents ---------------------------------------------------------------


def contents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, rows and digest of each table: a sum over the hashes of its rows, so neither order nor partitions show.

    Every business column counts, by name; a changed, missing or repeated row changes the sum. One pass a table, summed
    on the map side.
    """
    first = F.conv(F.substring("_row", 1, 15), 16, 10).cast("decimal(20,0)")
    parts = [
        df.select(record_hash(df).alias("_row"))
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum(first), F.lit(0)).cast("string").alias("digest"))
        .select(F.lit(name).alias("table_name"), "rows", "digest")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def altered(before: Mapping[str, tuple[int, str]], after: Mapping[str, tuple[int, str]]) -> list[str]:
    """Tables whose rows or digest differ between two states, or that only one of them has."""
    return sorted(name for name in {*before, *after} if before.get(name) != after.get(name))


def assert_same_contents(before: Mapping[str, tuple[int, str]], after: Mapping[str, tuple[int, str]]) -> None:
    if bad := altered(before, after):
        raise AuditError(f"contents differ: {', '.join(bad)}")


# --- Runs -------------------------------------------------------------------


def recent_runs(metrics: DataFrame, n: int = 2) -> DataFrame:
    """The newest ``n`` runs, numbered from the newest. The limit comes before
    the numbering, so the unpartitioned window sees ``n`` rows."""
    runs = metrics.groupBy("run_id").agg(F.max("processed_at_utc").alias("processed_at_utc"))
    newest = [F.desc("processed_at_utc"), F.desc("run_id")]
    return runs.orderBy(*newest).limit(n).withColumn("orden", F.row_number().over(Window.orderBy(*newest)))


def idempotence(metrics: DataFrame) -> DataFrame:
    """Row counts of the two newest runs side by side, per table."""
    recent = metrics.join(recent_runs(metrics).select("run_id", "orden"), "run_id")
    latest, previous = (F.max(F.when(F.col("orden") == i, F.col("row_count"))) for i in (1, 2))
    return (
        recent.groupBy("table_name")
        .agg(latest.alias("ejecucion_reciente"), previous.alias("ejecucion_anterior"))
        .withColumn("resultado_idempotente", F.col("ejecucion_reciente") == F.col("ejecucion_anterior"))
        .orderBy("table_name")
    )


def latest_runs(metrics: DataFrame, n: int = 2) -> DataFrame:
    """Totals of the newest silver runs."""
    totals = metrics.groupBy("run_id").agg(
        F.max("processed_at_utc").alias("processed_at_utc"),
        F.count_distinct("table_name").alias("tablas_procesadas"),
        F.sum("bronze_rows").alias("total_bronze"),
        F.sum("silver_rows").alias("total_silver"),
        F.sum("quarantined_rows").alias("total_cuarentena"),
    )
    return totals.orderBy(F.desc("processed_at_utc"), F.desc("run_id")).limit(n)


# --- Privacy ----------------------------------------------------------------


def pii_scan(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Per layer: personal columns exposed, protected ones, tables looked at, and
    how many rows the exposing tables hold.

    Schemas decide; only a table that exposes something is read, for its count.
    """
    parts = []
    for layer, tables in layers.items():
        for name, df in tables.items():
            exposes = any(c.lower() in PERSONAL_COLUMNS for c in df.columns)
            rows = df.agg(F.count("*").alias("filas")) if exposes else df.sparkSession.range(1).selectExpr("0L AS filas")
            columns = F.array(*[F.lit(c) for c in df.columns])
            parts.append(
                rows.select(
                    F.lit(layer).alias("capa"), F.lit(name).alias("tabla"), "filas", F.explode(columns).alias("columna")
                )
            )
    personal = F.lower("columna").isin(*PERSONAL_COLUMNS)
    per_table = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("capa", "tabla")
        .agg(
            F.count_if(personal).alias("personales"),
            F.count_if(F.lower("columna") == PROTECTED_ACCOUNT_COLUMN).alias("protegidas"),
            F.max("filas").alias("filas"),
        )
    )
    return per_table.groupBy("capa").agg(
        F.sum("personales").alias("columnas_personales_expuestas"),
        F.sum("protegidas").alias("columnas_cuenta_protegidas"),
        F.count("tabla").alias("tablas_inspeccionadas"),
        F.sum(F.when(F.col("personales") > 0, F.col("filas")).otherwise(0)).alias("filas_expuestas"),
    )
