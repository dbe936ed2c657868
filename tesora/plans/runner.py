"""Runs that write: stage, audit, publish.

Every table of a layer is written to a folder of its own attempt and audited
there. Only when the whole layer has passed is it published, all tables with one
commit, and metrics are appended last, once for each run. A failed run leaves the
previous snapshot published, also when it repeats the id of the run that
published it; so does a run upon a snapshot that another run has replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import quote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tesora.config import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SUCURSALES, UNKNOWN_CHANNEL, LakeConfig, RunContext
from tesora.operators import audit, rules
from tesora.plans import gold, silver
from tesora.session import SHUFFLES_GO, settings
from tesora.sources import bronze, control, extract, sinks, snapshots

LANDINGS = 4  # tables that land at a time
SORTED_SPLIT = {"spark.sql.files.maxPartitionBytes": "16m"}  # of files whose rows are sorted in memory; they are some 15 times as large there
SILVER_METRICS = ("run_id", "table_name", "bronze_rows", "silver_rows", "quarantined_rows", "processed_at_utc")
GOLD_METRICS = ("run_id", "table_name", "table_type", "row_count", "processed_at_utc")


@dataclass(frozen=True)
class LayerResult:
    tables: dict[str, DataFrame]
    metrics: DataFrame


@dataclass(frozen=True)
class BronzeResult:
    log: DataFrame
    errors: DataFrame
    config: DataFrame


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_bronze(
    spark: SparkSession,
    sources: Mapping[str, Callable[[], DataFrame | None]],
    config: DataFrame,
    cfg: LakeConfig,
    run: RunContext,
    feeds: Mapping[str, extract.ChangeFeed] | None = None,
    clock: Callable[[], datetime] = utc_now,
    register: bool = True,
) -> BronzeResult:
    """Extract and land every active table, log each outcome, advance progress.

    STARTED is stored before anything is copied, once for each (run, table).
    A pair that the log holds as SUCCEEDED is not copied again, so repeating a
    run under its id does what is left. Each table lands in a folder of its own
    attempt, ``LANDINGS`` at a time, so that a source read by few tasks does not
    hold up the others; then its outcome is logged, in the order of the tables,
    with the bound that it reached, and that event is its progress: see
    :func:`control.progress`. A crash before it
    means the same rows again with the next run, which deduplication absorbs;
    it never means missing rows. A table that fails is logged and leaves its
    progress where it was; the others go on. Events are numbered by claims, so
    two runs at a time never share a number. Only the configuration (a row per
    table) and one log row per event pass through the driver. ``log`` and
    ``errors`` of the result are this call's.
    """
    if register:
        sinks.ensure_namespaces(spark, cfg.root, cfg.schema_prefix)
    empty = spark.createDataFrame([], control.LOG_SCHEMA)

    def stored_log() -> DataFrame:
        return sinks.kept_rows(spark, cfg.root, "ctl", "pipeline_run_log", control.LOG_SCHEMA)

    log = stored_log()
    mine = log.where(F.col("pipeline_run_id") == run.run_id)
    finished = {r["source_table"] for r in control.latest_state(mine).where(F.col("status") == control.SUCCEEDED).collect()}
    seq = log.agg(F.max("seq")).first()[0] or 0
    added, failed = [], []

    def next_seq() -> int:
        nonlocal seq
        seq = snapshots.claim(spark, f"{cfg.root}/ctl/_claims", seq + 1)
        return seq

    def store(events: DataFrame) -> None:
        rows = empty.unionByName(events, allowMissingColumns=True)
        # Kept as local rows: what the result shows must not be read from a log that goes on growing.
        added.append(spark.createDataFrame(rows.collect(), control.LOG_SCHEMA))
        sinks.append_rows(added[-1].coalesce(1), cfg.root, "ctl", "pipeline_run_log", empty.columns, register, cfg.schema_prefix)

    known = control.progress(config, log)
    todo = [row for row in control.active_specs(known).collect() if row["source_table"] not in finished]
    asked = [(run.run_id, row["source_table"], run.batch, next_seq(), clock()) for row in todo]
    started = "pipeline_run_id string, source_table string, batch_id string, seq bigint, event_at_utc timestamp"
    store(control.start_runs(log, spark.createDataFrame(asked, started)))

    def land(row: Row) -> tuple[datetime, datetime, str, int, int, int, int | None]:
        begun = clock()
        spec = cfg.specs.get(row["source_table"].lower())
        state = extract.LoadState(
            strategy=row["load_strategy"],
            initial_load_completed=row["initial_load_completed"],
            last_change_version=row["last_change_version"],
            last_watermark_value=row["last_watermark_value"],
        )
        if spec is None:
            raise extract.ExtractError("SOURCE_MISSING", f"{row['source_table']} is configured but not known")
        delta = extract.plan_extract(spec, state, sources[spec.name], (feeds or {}).get(spec.name))
        read = Observation()
        rows = delta.rows.select(*spec.columns).observe(read, F.count("*").alias("rows"))
        path = bronze.land_bronze(rows, f"{cfg.root}/bronze", spec, cfg, run)
        copied = spark.read.parquet(path).count()
        size = spark.read.format("binaryFile").load(path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        return begun, clock(), path, read.get["rows"], copied, size, delta.bound

    with ThreadPoolExecutor(LANDINGS) as pool:
        landings = [pool.submit(inheritable_thread_target(spark)(land), row) for row in todo]
        for row, landing in zip(todo, landings):
            table = row["source_table"]
            try:
                begun, now, path, rows_read, copied, size, bound = landing.result()
            except Exception as error:  # recorded for this table; the run goes on
                code = getattr(error, "code", type(error).__name__)
                failure = (run.run_id, table, run.batch, next_seq(), clock(), "land_bronze", code, str(error), repr(error))
                columns = f"{started}, activity_name string, error_code string, error_message string, error_details string"
                event, detail = control.fail_runs(spark.createDataFrame([failure], columns))
                store(event)
                failed.append(spark.createDataFrame(detail.collect(), detail.schema))
                sinks.append_rows(failed[-1].coalesce(1), cfg.root, "ctl", "pipeline_error", [f.split()[0] for f in control.ERROR_SCHEMA.split(", ")], register, cfg.schema_prefix)
                continue
            done = (run.run_id, table, run.batch, next_seq(), now, rows_read, copied, size, int((now - begun).total_seconds()), path, bound)
            columns = f"{started}, rows_read bigint, rows_copied bigint, bytes_written bigint, duration_seconds int, output_path string, new_watermark bigint"
            completion = spark.createDataFrame([done], columns)
            control.assert_started(stored_log(), completion)
            store(control.complete_runs(stored_log(), completion).withColumn("new_watermark", F.lit(bound).cast("bigint")))

    versions = Versions(spark, cfg, run, "control")
    progress = versions.write(control.progress(config, stored_log()), "ctl", "ingestion_config")
    if register:
        versions.publish()
    none = spark.createDataFrame([], control.ERROR_SCHEMA)
    return BronzeResult(
        reduce(DataFrame.unionByName, added), reduce(DataFrame.unionByName, failed, none), progress
    )


def landed(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    return {name: bronze.read_bronze(spark, f"{cfg.root}/bronze", spec) for name, spec in cfg.specs.items()}


class Versions:
    """Writes table versions of one run, reads them back and publishes them together."""

    def __init__(self, spark: SparkSession, cfg: LakeConfig, run: RunContext, layer: str, root: str | None = None) -> None:
        self.spark, self.root, self.run, self.prefix = spark, root or cfg.root, run, cfg.schema_prefix
        self.version = f"{run.run_id}-{uuid.uuid4().hex}"
        self.layer = snapshots.Layer(spark, self.root, layer)
        built_upon = self.layer.newest()
        self.after = built_upon.seq if built_upon else 0
        self.written: dict[str, tuple[str, DataFrame]] = {}

    def write(self, df: DataFrame, schema: str, table: str, *more: DataFrame, sorted_rows: bool = False) -> DataFrame:
        """No attempt writes over another one: a run repeated under its id leaves what it published before as it is.

        ``more`` are further parts of the table. They are written one after the other, and the shuffle files of each are gone before
        the next is begun. Rows that are sorted on their way are read in small splits, so that no sort goes to disk.

        Record hashes and row images are most of what is written; they are text of few symbols, which zstandard halves and snappy does not.
        """
        path = snapshots.version_path(df, self.root, schema, table, quote(self.version, safe=""))
        with settings(self.spark, {**SHUFFLES_GO, **(SORTED_SPLIT if sorted_rows else {})}):
            for mode, part in (("errorifexists", df), *(("append", part) for part in more)):
                part.write.mode(mode).option("compression", "zstd").parquet(path)
        held = self.spark.read.schema(df.schema).parquet(path)
        self.written[f"{schema}.{table}"] = (path, held)
        return held

    def publish(self) -> snapshots.Commit:
        """One commit for all tables but staged ones, with the digest of each, if nobody has published since this run began."""
        tables = {name: held for name, held in self.written.items() if not name.startswith("staging.")}
        counted = audit.contents({name: df for name, (_, df) in tables.items()}).collect()  # a row for each table
        entries = {r["table_name"]: (tables[r["table_name"]][0], r["rows"], r["digest"]) for r in counted}
        commit = self.layer.commit(self.version, self.run.run_id, entries, self.after)
        self.layer.views(commit, self.prefix)
        return commit


def run_silver(
    spark: SparkSession,
    landed_tables: Mapping[str, DataFrame],
    cfg: LakeConfig,
    run: RunContext,
    root: str | None = None,
    register: bool = True,
) -> LayerResult:
    """Bronze to silver and quarantine.

    Each bronze table is judged once and written with its outcomes; silver,
    quarantine and metrics then read that staged table instead of repeating
    its shuffles. Silver facts are laid out by client and date within files.
    """
    versions = Versions(spark, cfg, run, "silver", root)
    refs, staged = silver.references(landed_tables, cfg), {}
    for name in cfg.specs:
        first, *more = [silver.drop_internal(part) for part in silver.stage_parts(landed_tables, name, cfg, refs)]
        staged[name] = versions.write(first, "staging", name, *more)
    tables = {}
    for name, df in staged.items():
        order = {MOVIMIENTOS: ("id_cli", "fec_mov"), OBLIGACIONES: ("id_cli",), COMISIONES: ("id_cli", "fec_cobro")}.get(name, ())
        tables[name] = versions.write(silver.silver_from_stage(df, name, cfg, run, order), "silver", name, sorted_rows=bool(order))

    rejected = versions.write(rules.quarantine_all(staged, cfg.specs, run), "quality", "rejected_records")
    stamp = F.lit(run.as_of).cast("timestamp")
    summary = rules.rule_summary(rejected).withColumns({"run_id": F.lit(run.run_id), "processed_at_utc": stamp})
    versions.write(summary, "quality", "rule_summary")
    metrics = versions.write(rules.stage_metrics(staged, run).coalesce(1), "staging", "silver_run_metrics")

    audit.assert_count(metrics, len(cfg.specs), "silver run metrics")
    empty = [row["table_name"] for row in metrics.where("silver_rows <= 0").collect()]  # one row per table
    if empty:
        raise audit.AuditError(f"empty silver tables: {', '.join(empty)}")
    audit.assert_domain(tables[MOVIMIENTOS], "cod_canal", (*cfg.allowed_channels, UNKNOWN_CHANNEL))

    if register:
        sinks.ensure_namespaces(spark, versions.root, cfg.schema_prefix)
        versions.publish()
        snapshots.append_once(metrics, versions.root, "quality", "silver_run_metrics", SILVER_METRICS, run.run_id, prefix=cfg.schema_prefix)
    return LayerResult(tables, metrics)


def run_gold(
    spark: SparkSession,
    silver_tables: Mapping[str, DataFrame],
    cfg: LakeConfig,
    run: RunContext,
    root: str | None = None,
    register: bool = True,
) -> LayerResult:
    """Silver to gold. Facts and dimensions are written once; marts, audits and
    reconciliations read the written versions."""
    versions = Versions(spark, cfg, run, "gold", root)
    stamp = F.lit(run.as_of).cast("timestamp")

    def write(df: DataFrame, name: str) -> DataFrame:
        return versions.write(df.withColumn("_gold_processed_at_utc", stamp), "gold", name)

    star = {name: write(df, name) for name, df in gold.build_star(silver_tables, cfg).items()}
    plain = {name: df.drop("_gold_processed_at_utc") for name, df in star.items()}
    marts = {name: write(df, name) for name, df in gold.build_marts(plain, cfg, run).items()}
    tables = {**star, **marts}

    for name, df in tables.items():
        audit.assert_unique(df, [gold.KEYS[name]], name)
        audit.assert_not_empty(df, name)
    audit.assert_no_orphans(audit.orphan_counts(star))
    valid = silver_tables[MOVIMIENTOS].where(silver.IN_PERIOD)
    held = {
        "fact_movimientos": valid, "fact_obligaciones": silver_tables[OBLIGACIONES],
        "fact_comisiones": silver_tables[COMISIONES], "dim_cliente": silver_tables[CLIENTES],
        "dim_producto": silver_tables[PRODUCTOS], "dim_sucursal": silver_tables[SUCURSALES],
    }
    audit.assert_reconciled(audit.reconcile_counts(held, {name: star[name] for name in held}))
    sums = {
        "valor_total_movimientos": (valid, "fact_movimientos", "vr_mov"),
        "saldo_total_cartera": (silver_tables[OBLIGACIONES], "fact_obligaciones", "sdo_capital"),
        "ingreso_total_comisiones": (silver_tables[COMISIONES], "fact_comisiones", "vr_comision"),
    }
    audit.assert_reconciled(
        audit.reconcile_sums(
            {name: (df, column) for name, (df, _, column) in sums.items()},
            {name: (star[fact], column) for name, (_, fact, column) in sums.items()},
        )
    )

    rows = audit.controls({name: (df, F.count("*")) for name, df in tables.items()})
    kind = F.element_at(F.create_map(*[F.lit(x) for pair in gold.KINDS.items() for x in pair]), F.col("table_name"))
    metrics = versions.write(
        rows.select(F.col("control").alias("table_name"), F.col("valor").alias("row_count"))
        .select(F.lit(run.run_id).alias("run_id"), "table_name", kind.alias("table_type"), "row_count", stamp.alias("processed_at_utc"))
        .coalesce(1),
        "staging",
        "gold_run_metrics",
    )
    audit.assert_count(metrics, len(gold.KINDS), "gold run metrics")

    if register:
        sinks.ensure_namespaces(spark, versions.root, cfg.schema_prefix)
        versions.publish()
        snapshots.append_once(metrics, versions.root, "gold", "gold_run_metrics", GOLD_METRICS, run.run_id, prefix=cfg.schema_prefix)
    return LayerResult(tables, metrics)


def run_lake(spark: SparkSession, cfg: LakeConfig, run: RunContext) -> tuple[LayerResult, LayerResult]:
    """Landed files to published gold."""
    silver_run = run_silver(spark, landed(spark, cfg), cfg, run)
    sinks.require_tables(spark, f"{cfg.schema_prefix}silver", list(cfg.specs))
    snapshot = snapshots.Layer(spark, cfg.root, "silver").read()  # gold is built from one commit, whatever follows it
    published = {name: snapshot[f"silver.{name}"] for name in cfg.specs}
    return silver_run, run_gold(spark, published, cfg, run)
