"""Every registered query over the bound tables.

Results keep their exact types up to :func:`present`, which renders decimals as
doubles, integers as bigints and dates as ISO text so that two engines compare
alike through any client.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import replace
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DateType, DecimalType, IntegerType, ShortType, StructField

from tesora.config import (
    CLIENTES,
    COMISIONES,
    MOVIMIENTOS,
    OBLIGACIONES,
    PRODUCTOS,
    SUCURSALES,
    UNKNOWN_CHANNEL,
    RunContext,
)
from tesora.functions.columns import date_key
from tesora.operators import audit, cleanse, quality, reports, rules
from tesora.operators.rolling import DEVIATION, MEAN, SAMPLES
from tesora.plans import gold, runner, silver
from tesora.session import SHUFFLES_GO, scratch_dir, settings
from tesora.sources import bindings, bronze, control, extract, sinks, snapshots
from tesora.streaming.alerts import failure_alerts
from tesora.streaming.landing import stream_bronze

CFG, RUN = bindings.CONFIG, bindings.RUN
FACTS = (MOVIMIENTOS, OBLIGACIONES, COMISIONES)
TECHNICAL_OUTPUT = (
    "_batch_id", "_ingestion_timestamp_utc", "_source_system", "_source_file", "_silver_processed_at_utc", "updated_at_utc",
)


# Integers that may be absent; pandas has no null bigint, so they go as doubles.
SPARSE_INTEGERS = (
    "score_buro", "ultima_fecha_movimiento_key", "cantidad_mov_30d", "last_change_version", "last_watermark_value",
)


def present(df: DataFrame) -> DataFrame:
    def rendered(field: StructField) -> str:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, DecimalType) or field.name in SPARSE_INTEGERS:
            return f"cast({name} AS double) AS {name}"
        if isinstance(kind, (ByteType, ShortType, IntegerType)):
            return f"cast({name} AS bigint) AS {name}"
        if isinstance(kind, DateType):
            return f"cast({name} AS string) AS {name}"
        return name

    return df.selectExpr(*[rendered(f) for f in df.schema.fields if f.name not in TECHNICAL_OUTPUT])


class OnDemand(Mapping[str, DataFrame]):
    """Frames built when first asked for, so a query plans only what it reads."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]) -> None:
        self.names, self.build, self.built = list(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.built:
            self.built[name] = self.build(name)
        return self.built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


class Lake:
    """The layers over one folder of test tables, built on demand and lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def source(self, name: str) -> DataFrame:
        return bindings.source_table(self.spark, self.sf_dir, name)

    def owned(self, name: str) -> DataFrame:
        """A source table with the columns its owner gave it, only."""
        return self.source(name).select(*CFG.specs[name].columns)

    def control(self, name: str) -> DataFrame:
        return bindings.control_table(self.spark, self.sf_dir, name)

    @cached_property
    def bronze(self) -> Mapping[str, DataFrame]:
        return OnDemand(CFG.specs, lambda name: bindings.bronze_table(self.spark, self.sf_dir, name))

    @cached_property
    def refs(self) -> rules.References:
        return silver.references(self.bronze, CFG)

    @cached_property
    def silver(self) -> Mapping[str, DataFrame]:
        return OnDemand(CFG.specs, lambda name: silver.build_table(self.bronze, name, CFG, refs=self.refs))

    @cached_property
    def staged(self) -> Mapping[str, DataFrame]:
        return OnDemand(CFG.specs, lambda name: silver.stage_table(self.bronze, name, CFG, self.refs))

    @cached_property
    def quarantine(self) -> DataFrame:
        return rules.quarantine_all(self.staged, CFG.specs, RUN)

    @cached_property
    def star(self) -> Mapping[str, DataFrame]:
        return OnDemand(gold.STAR, lambda name: gold.star_table(self.silver, name, CFG))

    @cached_property
    def marts(self) -> Mapping[str, DataFrame]:
        return OnDemand(gold.MARTS, lambda name: gold.mart_table(self.star, name, CFG, RUN))

    def holding(self, columns: Mapping[str, Sequence[str]]) -> Lake:
        """This lake with some columns of its silver facts written once, for plans that read a fact several times.

        Each reader would else rank the copies of all bronze rows again. The facts have all of their rows; columns that are
        not named are null.
        """
        lake, root = Lake(self.spark, self.sf_dir), self.folder("held")

        def held(name: str) -> DataFrame:
            whole = self.silver[name]
            if name not in columns:
                return whole
            narrow = silver.narrow_fact(self.bronze, name, columns[name], CFG, self.refs)
            narrow.write.option("compression", "zstd").parquet(f"{root}/{name}")
            read = self.spark.read.schema(narrow.schema).parquet(f"{root}/{name}")
            rest = {f.name: F.lit(None).cast(f.dataType) for f in whole.schema.fields if f.name not in columns[name]}
            return read.withColumns(rest).select(*whole.columns)

        lake.silver = OnDemand(CFG.specs, held)
        return lake

    def latest(self, name: str) -> DataFrame:
        """Standardised, deduplicated rows, references not yet checked."""
        spec = CFG.specs[name]
        return cleanse.keep_latest(
            cleanse.standardize(self.bronze[name], spec.uppercase), spec.key, spec.order_columns
        )

    def referenced(self, name: str) -> DataFrame:
        return rules.check_references(self.latest(name), self.refs, [CFG.specs[name].key], CFG.salt_buckets).withColumn(
            "reglas", rules.rule_string(rules.reference_rules())
        )

    def exported(self, label: str) -> str:
        """The folder of an export of every source table."""
        out = self.folder(label)
        sinks.export_tables({name: self.owned(name) for name in CFG.specs}, out)
        return out

    def one_by_one(self, small: Mapping[str, DataFrame]) -> list[DataFrame]:
        """Results of few rows, written one after the other, so that only the shuffle files of one are there at a time."""
        root = self.folder("results")
        for name, df in small.items():
            with settings(self.spark, SHUFFLES_GO):
                df.write.parquet(f"{root}/{name}")
        return [self.spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in small.items()]

    def folder(self, label: str) -> str:
        return scratch_dir(self.spark, label)


Query = Callable[[Lake], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _QUERIES[name] = build
        return build

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: present(build(Lake(spark, sf_dir)))

    return {name: bind(build) for name, build in _QUERIES.items()}


# --- Extraction, landing, control -------------------------------------------


@query("bronze_watermark_delta")
def _(lake: Lake) -> DataFrame:
    return extract.watermark_delta(lake.owned(MOVIMIENTOS), "id_mov", 5_000, initial=False).rows


@query("bronze_change_delta")
def _(lake: Lake) -> DataFrame:
    return extract.change_feed_delta(lake.owned(CLIENTES), lake.control("client_changes"), "id_cli", last=4, bound=8)


@query("ctl_active_config")
def _(lake: Lake) -> DataFrame:
    return control.active_specs(lake.control("config"))


@query("ctl_config_upsert")
def _(lake: Lake) -> DataFrame:
    return control.upsert_config(lake.control("config"), lake.control("config_changes"), RUN.as_of)


@query("ctl_run_start")
def _(lake: Lake) -> DataFrame:
    log = lake.control("run_log")
    known, requested = log.where("status = 'SKIPPED'"), log.where("status = 'STARTED'")
    return control.start_runs(known, requested)


@query("ctl_run_complete")
def _(lake: Lake) -> DataFrame:
    log = lake.control("run_log")
    return control.complete_runs(log.where("status = 'STARTED'"), log.where("status = 'SUCCEEDED'"))


@query("ctl_run_progress")
def _(lake: Lake) -> DataFrame:
    done = lake.control("run_log").where("status = 'SUCCEEDED'")
    return control.advance_progress(lake.control("config"), done, RUN.as_of)


@query("ctl_run_fail")
def _(lake: Lake) -> DataFrame:
    return control.fail_runs(lake.control("run_log").where("status = 'FAILED'"))[0]


@query("ctl_run_errors")
def _(lake: Lake) -> DataFrame:
    return control.fail_runs(lake.control("run_log").where("status = 'FAILED'"))[1]


@query("ctl_latest_state")
def _(lake: Lake) -> DataFrame:
    log = lake.control("run_log").select(
        "pipeline_run_id", "source_table", "batch_id", "seq", "status", "event_at_utc", "rows_read", "rows_copied"
    )
    return control.latest_state(log)


@query("ctl_failure_alerts")
def _(lake: Lake) -> DataFrame:
    return failure_alerts(lake.control("run_log"))


def two_batches(lake: Lake, name: str, root: str) -> None:
    """Land a source table as its first load and one later delivery."""
    df, spec = lake.source(name), CFG.specs[name]
    for batch in (1, 2):
        run = RunContext(run_id=f"RUN-{batch}", as_of=datetime(2024, 2, batch), batch_id=str(batch))
        part = df.where(F.col("_batch_id") == batch).select(*spec.columns)
        bronze.land_bronze(part, root, spec, CFG, run)


@query("bronze_land_roundtrip")
def _(lake: Lake) -> DataFrame:
    root, spec = lake.folder("land"), CFG.specs[MOVIMIENTOS]
    two_batches(lake, MOVIMIENTOS, root)
    return bronze.read_bronze(lake.spark, root, spec).select(*spec.columns)


@query("bronze_read")
def _(lake: Lake) -> DataFrame:
    root, spec = lake.folder("read"), CFG.specs[MOVIMIENTOS]
    two_batches(lake, MOVIMIENTOS, root)
    landed = bronze.read_bronze(lake.spark, root, spec)
    return landed.groupBy(F.col("_batch_id").alias("lote"), F.col("_ingestion_timestamp_utc").cast("date").alias("dia")).agg(
        F.count("*").alias("filas"), F.count_distinct("_source_file", "_row_index").alias("posiciones")
    )


@query("bronze_compacted")
def _(lake: Lake) -> DataFrame:
    """The first delivery compacted, the second as it landed: the rows of both, with the names and positions they landed with."""
    root, spec = lake.folder("compact"), CFG.specs[MOVIMIENTOS]
    two_batches(lake, MOVIMIENTOS, root)
    bronze.compact(lake.spark, root, spec, date(2024, 2, 2))
    held = bronze.read_compacted(lake.spark, root, spec)
    return held.groupBy(F.col("_batch_id").alias("lote"), F.col("_ingestion_timestamp_utc").cast("date").alias("dia")).agg(
        F.count("*").alias("filas"), F.count_distinct("_source_file", "_row_index").alias("posiciones")
    )


@query("ingest_retry")
def _(lake: Lake) -> DataFrame:
    """A run in which one source is down, and its repetition under the same id: all rows, one final state for each table."""
    cfg = replace(CFG, root=lake.folder("ingest"))
    initial = [
        ("dbo", name.upper(), spec.strategy, spec.key, spec.watermark_column, None, None, False, True, RUN.as_of) for name, spec in cfg.specs.items()
    ]
    config = lake.spark.createDataFrame(initial, control.CONFIG_SCHEMA)
    feeds = {}
    for name, spec in cfg.specs.items():
        none = lake.spark.createDataFrame([], f"{spec.key} {spec.types[spec.key]}, version bigint, op string")
        feeds[name] = extract.ChangeFeed(none, current_version=1, min_valid_version=1)
    sources = {name: (lambda name=name: lake.owned(name)) for name in cfg.specs}

    def down() -> DataFrame:
        raise ConnectionError("source is down")

    first = runner.run_bronze(lake.spark, {**sources, PRODUCTOS: down}, config, cfg, RUN, feeds, register=False)
    runner.run_bronze(lake.spark, sources, first.config, cfg, RUN, feeds, register=False)
    log = sinks.kept_rows(lake.spark, cfg.root, "ctl", "pipeline_run_log", control.LOG_SCHEMA)
    state = control.latest_state(log).select(F.lower("source_table").alias("tabla"), F.col("status").alias("estado"))
    events = log.groupBy(F.lower("source_table").alias("tabla")).agg(F.count("*").alias("eventos"))
    landed = reports.table_counts({name: bronze.read_bronze(lake.spark, f"{cfg.root}/bronze", spec) for name, spec in cfg.specs.items()})
    landed = landed.toDF("tabla", "filas")
    return landed.join(state, "tabla", "left").join(events, "tabla", "left")


@query("ingest_stale_config")
def _(lake: Lake) -> DataFrame:
    """Two runs that were both given the first configuration: the second starts from what the log proves and lands no row again."""
    cfg, at = replace(CFG, root=lake.folder("stale")), RUN.as_of
    initial = [
        ("dbo", name.upper(), spec.strategy, spec.key, spec.watermark_column, None, None, False, True, at) for name, spec in cfg.specs.items()
    ]
    config, feeds = lake.spark.createDataFrame(initial, control.CONFIG_SCHEMA), {}
    for name, spec in cfg.specs.items():
        none = lake.spark.createDataFrame([], f"{spec.key} {spec.types[spec.key]}, version bigint, op string")
        feeds[name] = extract.ChangeFeed(none, current_version=1, min_valid_version=1)
    sources = {name: (lambda name=name: lake.owned(name)) for name in cfg.specs}
    for again in ("A", "B"):
        last = runner.run_bronze(lake.spark, sources, config, cfg, replace(RUN, run_id=f"RUN-{again}"), feeds, register=False)
    landed = reports.table_counts({name: bronze.read_bronze(lake.spark, f"{cfg.root}/bronze", spec) for name, spec in cfg.specs.items()})
    moved = last.config.select(
        F.lower("source_table").alias("tabla"), F.coalesce("last_change_version", "last_watermark_value").alias("marca"), "initial_load_completed"
    )
    return landed.toDF("tabla", "filas").join(moved, "tabla")


@query("bronze_stream_available_now")
def _(lake: Lake) -> DataFrame:
    root, spec = lake.folder("stream"), CFG.specs[MOVIMIENTOS]
    rows = lake.source(MOVIMIENTOS)
    schema = rows.select(*spec.columns).schema
    for batch in (1, 2):
        rows.where(F.col("_batch_id") == batch).select(*spec.columns).write.mode("append").parquet(f"{root}/in")
        stream_bronze(
            lake.spark, spec, CFG, RUN, f"{root}/in", f"{root}/out", f"{root}/progress", schema=schema
        ).awaitTermination()
    return lake.spark.read.parquet(f"{root}/out").select(*spec.columns)


def hash_checks(lake: Lake, out: str | None = None) -> DataFrame:
    """Every table exported (or an export that is there) and its files' digests compared with the recorded ones, of which one was altered."""
    out = out or lake.exported("export")
    found = sinks.manifest(lake.spark, {name: lake.owned(name).columns for name in CFG.specs}, out)
    altered = (F.col("table_name") == PRODUCTOS) & (F.col("format") == "csv")
    recorded = found.withColumn("sha256", F.when(altered, F.sha2(F.lit("altered").cast("binary"), 256)).otherwise(F.col("sha256")))
    differing = quality.check_hashes(found, recorded).withColumn("_differs", F.lit(True))
    return (
        found.join(differing, "path", "left")
        .groupBy("table_name", "format", "columns")
        .agg(F.sum("rows").alias("filas"), (F.count("_differs") == 0).alias("huellas_validas"))
    )


def file_checks(lake: Lake, out: str | None = None) -> DataFrame:
    """Every exported table, and one that is expected but was not exported."""
    out = out or lake.exported("files")
    with settings(lake.spark, SHUFFLES_GO):
        expected = {name: lake.owned(name).count() for name in CFG.specs}
    return quality.check_files(lake.spark, out, {**expected, "tb_ausente": 1})


query("export_manifest")(hash_checks)
query("dq_check_files")(file_checks)


@query("load_reconcile")
def _(lake: Lake) -> DataFrame:
    root = lake.folder("load")

    def write(name: str, df: DataFrame) -> None:
        sinks.normalize(df, CFG.specs[name]).write.mode("append").parquet(f"{root}/{name}")

    def loaded(name: str) -> DataFrame:
        return lake.spark.read.parquet(f"{root}/{name}")

    frames = {name: lake.owned(name) for name in CFG.specs}
    sinks.load_tables(frames, write, lambda name: loaded(name).count())
    return reports.table_counts({name: loaded(name) for name in frames})


@query("publish_silver")
def _(lake: Lake) -> DataFrame:
    result = runner.run_silver(lake.spark, lake.bronze, CFG, RUN, lake.folder("silver"), register=False)
    return reports.table_counts(result.tables)


@query("publish_silver_contents")
def _(lake: Lake) -> DataFrame:
    """What a silver run writes for publication, row by row."""
    result = runner.run_silver(lake.spark, lake.bronze, CFG, RUN, lake.folder("silver"), register=False)
    return result.tables[MOVIMIENTOS]


@query("publish_gold_contents")
def _(lake: Lake) -> DataFrame:
    root = lake.folder("gold")
    silver_run = runner.run_silver(lake.spark, lake.bronze, CFG, RUN, root, register=False)
    return runner.run_gold(lake.spark, silver_run.tables, CFG, RUN, root, register=False).tables["mart_cliente_360"].drop("_gold_processed_at_utc")


@query("publish_layers")
def _(lake: Lake) -> DataFrame:
    """Both layers published, each with one commit, and every table read through its published name: rows and digest."""
    cfg = replace(CFG, root=lake.folder("layers"), schema_prefix="published_")
    silver_run = runner.run_silver(lake.spark, lake.bronze, cfg, RUN)
    runner.run_gold(lake.spark, silver_run.tables, cfg, RUN)
    names = [f"silver.{name}" for name in cfg.specs] + [f"gold.{name}" for name in gold.KINDS]
    return audit.contents({name: lake.spark.table(f"published_{name}") for name in names})


@query("publish_metrics_once")
def _(lake: Lake) -> DataFrame:
    """A run's metrics appended twice, the second time with other figures: the first append stands alone."""
    root, columns = lake.folder("metrics"), runner.SILVER_METRICS[:-1]
    metrics = rules.stage_metrics(lake.staged, RUN).select(*columns)
    for df in (metrics, metrics.withColumn("silver_rows", F.lit(-1).cast("bigint"))):
        snapshots.append_once(df, root, "quality", "silver_run_metrics", columns, RUN.run_id, register=False)
    return snapshots.appended(lake.spark, root, "quality", "silver_run_metrics", "run_id string, table_name string, bronze_rows bigint, silver_rows bigint, quarantined_rows bigint")


@query("audit_altered_contents")
def _(lake: Lake) -> DataFrame:
    """Contents of all silver tables against those with one cent more in one commission: only that table's digest differs."""
    one = lake.silver[COMISIONES].agg(F.min("id_comision")).first()[0]
    cent = F.when(F.col("id_comision") == one, F.col("vr_comision") + F.lit("0.01").cast("decimal(18,2)")).otherwise(F.col("vr_comision"))
    changed = lake.silver[COMISIONES].withColumn("vr_comision", cent.cast("decimal(18,2)"))
    before = audit.contents(lake.silver)
    after = audit.contents({name: changed if name == COMISIONES else df for name, df in lake.silver.items()}).toDF("table_name", "rows_after", "digest_after")
    return before.join(after, "table_name").select("table_name", "rows", "rows_after", (F.col("digest") == F.col("digest_after")).alias("resultado"))


@query("publish_gold")
def _(lake: Lake) -> DataFrame:
    root = lake.folder("gold")
    silver_run = runner.run_silver(lake.spark, lake.bronze, CFG, RUN, root, register=False)
    result = runner.run_gold(lake.spark, silver_run.tables, CFG, RUN, root, register=False)
    return reports.run_report(result.metrics).select("table_type", "table_name", "row_count")


# --- Cleansing and rules ----------------------------------------------------


@query("clean_standardize")
def _(lake: Lake) -> DataFrame:
    return cleanse.standardize(lake.owned(CLIENTES), CFG.specs[CLIENTES].uppercase)


@query("clean_null_keys")
def _(lake: Lake) -> DataFrame:
    held, missing = cleanse.split_null_keys(lake.source(MOVIMIENTOS), "id_dispositivo")
    columns = ("id_mov", "id_dispositivo")
    return held.select(*columns, F.lit("CON_LLAVE").alias("lado")).unionByName(
        missing.select(*columns, F.lit("LLAVE_PRIMARIA_NULA").alias("lado"))
    )


@query("dedupe_latest")
def _(lake: Lake) -> DataFrame:
    spec = CFG.specs[OBLIGACIONES]
    kept, _ = cleanse.dedupe_latest(lake.source(OBLIGACIONES), spec.key, spec.order_columns)
    return silver.drop_internal(kept)


@query("dedupe_discarded")
def _(lake: Lake) -> DataFrame:
    spec = CFG.specs[OBLIGACIONES]
    _, discarded = cleanse.dedupe_latest(lake.source(OBLIGACIONES), spec.key, spec.order_columns)
    return silver.drop_internal(discarded)


@query("ref_invalid")
def _(lake: Lake) -> DataFrame:
    return lake.referenced(OBLIGACIONES).where("reglas <> ''").select("id_oblig", "id_cli", "cod_prod", "reglas")


@query("ref_valid")
def _(lake: Lake) -> DataFrame:
    valid = lake.referenced(COMISIONES).where("reglas = ''")
    return valid.select(*CFG.specs[COMISIONES].columns)


@query("oblig_flags")
def _(lake: Lake) -> DataFrame:
    found = rules.rule_string(silver.rules_for(OBLIGACIONES, CFG))
    return silver.screened(lake.bronze, OBLIGACIONES, CFG, lake.refs).select(
        "id_oblig", "ind_montos_consistentes", "ind_fechas_consistentes", found.alias("reglas")
    )


@query("commission_negative")
def _(lake: Lake) -> DataFrame:
    found = rules.rule_string(silver.rules_for(COMISIONES, CFG))
    return (
        silver.screened(lake.bronze, COMISIONES, CFG, lake.refs)
        .select("id_comision", "vr_comision", found.alias("reglas"))
        .where("reglas <> ''")
    )


@query("mov_flags")
def _(lake: Lake) -> DataFrame:
    return silver.screened(lake.bronze, MOVIMIENTOS, CFG, lake.refs).select(
        "id_mov", "cod_canal", "cod_canal_original", "ind_fecha_rango_valido", "ind_canal_valido"
    )


@query("quarantine_all")
def _(lake: Lake) -> DataFrame:
    return lake.quarantine.select("run_id", "table_name", "primary_key_value", "quality_rules", "batch_id", "source_file")


@query("quality_rule_summary")
def _(lake: Lake) -> DataFrame:
    return reports.rule_listing(rules.rule_summary(lake.quarantine))


@query("silver_run_metrics")
def _(lake: Lake) -> DataFrame:
    return rules.stage_metrics(lake.staged, RUN).drop("processed_at_utc")


@query("guard_channels")
def _(lake: Lake) -> DataFrame:
    """How many movements each published channel has, and whether the domain knows it."""
    allowed = (*CFG.allowed_channels, UNKNOWN_CHANNEL)
    return quality.check_domain(silver.screened(lake.bronze, MOVIMIENTOS, CFG, lake.refs), "cod_canal", allowed)


@query("record_hash")
def _(lake: Lake) -> DataFrame:
    return lake.silver[PRODUCTOS].select("cod_prod", "_record_hash")


@query("rolling_stats_30d")
def _(lake: Lake) -> DataFrame:
    return lake.silver[MOVIMIENTOS].select("id_mov", MEAN, DEVIATION, SAMPLES)


@query("suspicious_movements")
def _(lake: Lake) -> DataFrame:
    return lake.silver[MOVIMIENTOS].where("ind_sospechoso").select("id_mov", "id_cli", "fec_mov", "vr_mov", MEAN, DEVIATION, SAMPLES)


SILVER_NAMES = {
    "silver_clientes": CLIENTES, "silver_productos": PRODUCTOS, "silver_sucursales": SUCURSALES,
    "silver_obligaciones": OBLIGACIONES, "silver_comisiones": COMISIONES, "silver_movimientos": MOVIMIENTOS,
}
for _name, _table in SILVER_NAMES.items():
    query(_name)(lambda lake, t=_table: lake.silver[t])


# --- Star and marts ---------------------------------------------------------


@query("date_bounds")
def _(lake: Lake) -> DataFrame:
    return gold.date_bounds(lake.silver[MOVIMIENTOS], lake.silver[OBLIGACIONES], lake.silver[COMISIONES])


for _name in ("dim_fecha", "dim_cliente", "dim_producto", "dim_sucursal", "fact_movimientos", "fact_obligaciones", "fact_comisiones"):
    query(_name)(lambda lake, t=_name: lake.star[t])

MEASURES = {
    "agg_mov": (gold.movements_by, "fact_movimientos"),
    "agg_oblig": (gold.obligations_by, "fact_obligaciones"),
    "agg_com": (gold.commissions_by, "fact_comisiones"),
}
for _prefix, (_measure, _fact) in MEASURES.items():
    for _by in ("cliente", "producto"):
        query(f"{_prefix}_{_by}")(lambda lake, m=_measure, f=_fact, k=f"{_by}_key": m(lake.star[f], k))

for _name, _table in (
    ("mart_cliente_360", "mart_cliente_360"),
    ("mart_producto_rendimiento", "mart_producto_rendimiento"),
    ("kpi_resumen", "kpi_resumen_bancario"),
):
    query(_name)(lambda lake, t=_table: lake.marts[t])


# --- Audits -----------------------------------------------------------------


@query("audit_duplicate_keys")
def _(lake: Lake) -> DataFrame:
    return audit.duplicate_key_counts({name: (lake.source(name), [CFG.specs[name].key]) for name in CFG.specs})


@query("audit_orphans")
def _(lake: Lake) -> DataFrame:
    """The ten relations over facts whose references were not screened."""
    keys = [F.col("id_cli").alias("cliente_key"), F.col("cod_prod").alias("producto_key")]
    movements, obligations, fees = (lake.latest(name) for name in FACTS)
    facts = {
        "fact_movimientos": movements.select(*keys, date_key("fec_mov").alias("fecha_key")),
        "fact_obligaciones": obligations.select(
            *keys, date_key("fec_desembolso").alias("fecha_desembolso_key"), date_key("fec_venc").alias("fecha_venc_key")
        ),
        "fact_comisiones": fees.select(*keys, date_key("fec_cobro").alias("fecha_key")),
    }
    return audit.orphan_counts({**lake.star, **facts})


@query("audit_reconcile_counts")
def _(lake: Lake) -> DataFrame:
    s = lake.silver
    held = {
        "fact_movimientos": s[MOVIMIENTOS].where(silver.IN_PERIOD), "fact_obligaciones": s[OBLIGACIONES],
        "fact_comisiones": s[COMISIONES], "dim_cliente": s[CLIENTES], "dim_producto": s[PRODUCTOS],
        "dim_sucursal": s[SUCURSALES],
    }
    return audit.reconcile_counts(held, {name: lake.star[name] for name in held})


@query("audit_reconcile_sums")
def _(lake: Lake) -> DataFrame:
    s, g = lake.silver, lake.star
    return audit.reconcile_sums(
        {
            "valor_total_movimientos": (s[MOVIMIENTOS].where(silver.IN_PERIOD), "vr_mov"),
            "saldo_total_cartera": (s[OBLIGACIONES], "sdo_capital"),
            "ingreso_total_comisiones": (s[COMISIONES], "vr_comision"),
        },
        {
            "valor_total_movimientos": (g["fact_movimientos"], "vr_mov"),
            "saldo_total_cartera": (g["fact_obligaciones"], "sdo_capital"),
            "ingreso_total_comisiones": (g["fact_comisiones"], "vr_comision"),
        },
    )


@query("audit_idempotence")
def _(lake: Lake) -> DataFrame:
    return audit.idempotence(lake.control("run_metrics"))


@query("audit_latest_runs")
def _(lake: Lake) -> DataFrame:
    return audit.latest_runs(lake.control("run_metrics"))


@query("audit_pii_columns")
def _(lake: Lake) -> DataFrame:
    return audit.pii_scan({"silver": lake.silver, "gold": {**lake.star, **lake.marts}})


# --- Reports ----------------------------------------------------------------


@query("report_source_counts")
def _(lake: Lake) -> DataFrame:
    return reports.table_counts({name.upper(): lake.source(name) for name in CFG.specs})


@query("report_silver_counts")
def _(lake: Lake) -> DataFrame:
    return reports.table_counts(lake.silver)


@query("report_mov_quality")
def _(lake: Lake) -> DataFrame:
    return reports.movement_profile(lake.silver[MOVIMIENTOS])


SILVER_RELATIONS = [
    audit.Relation(f"{label}_sin_{what}", fact, fk, dim, fk)
    for label, fact in (("movimientos", MOVIMIENTOS), ("obligaciones", OBLIGACIONES), ("comisiones", COMISIONES))
    for what, dim, fk in (("cliente", CLIENTES, "id_cli"), ("producto", PRODUCTOS, "cod_prod"))
]


@query("report_silver_integrity")
def _(lake: Lake) -> DataFrame:
    return audit.orphan_totals(lake.silver, SILVER_RELATIONS)


@query("report_suspicious_top20")
def _(lake: Lake) -> DataFrame:
    return reports.top_suspicious(lake.silver[MOVIMIENTOS])


FACT_DATES = {MOVIMIENTOS: (silver.IN_PERIOD, "fec_mov"), OBLIGACIONES: ("fec_desembolso", "fec_venc"), COMISIONES: ("fec_cobro",)}


@query("report_gold_counts")
def _(lake: Lake) -> DataFrame:
    lake = lake.holding(FACT_DATES)
    return reports.table_counts({**lake.star, **lake.marts})


@query("report_kpi")
def _(lake: Lake) -> DataFrame:
    return reports.kpi_view(lake.marts["kpi_resumen_bancario"])


@query("report_gold_integrity")
def _(lake: Lake) -> DataFrame:
    lake = lake.holding({name: ("id_cli", "cod_prod", *dates) for name, dates in FACT_DATES.items()})
    return audit.orphan_counts(lake.star).orderBy("control")


@query("report_alert_segments")
def _(lake: Lake) -> DataFrame:
    return reports.alert_segments(lake.marts["mart_cliente_360"])


@query("report_top_products")
def _(lake: Lake) -> DataFrame:
    return reports.top_products(lake.marts["mart_producto_rendimiento"])


@query("report_duplicate_ids")
def _(lake: Lake) -> DataFrame:
    return reports.duplicate_ids(lake.source(MOVIMIENTOS), "id_mov")


@query("report_out_of_period")
def _(lake: Lake) -> DataFrame:
    return reports.out_of_period(lake.owned(MOVIMIENTOS), "fec_mov", CFG.start_date, CFG.end_date)


@query("report_invalid_channel")
def _(lake: Lake) -> DataFrame:
    clean = cleanse.standardize(lake.owned(MOVIMIENTOS), CFG.specs[MOVIMIENTOS].uppercase)
    return audit.outside_domain(clean, "cod_canal", CFG.allowed_channels)


@query("report_run_metrics")
def _(lake: Lake) -> DataFrame:
    return reports.run_report(lake.control("run_metrics").select("run_id", "table_type", "table_name", "row_count"))


@query("audit_reconcile_detects")
def _(lake: Lake) -> DataFrame:
    """A gold side that lost movements, lacks a control and has one too many."""
    held = {"movimientos": lake.owned(MOVIMIENTOS), "comisiones": lake.owned(COMISIONES), "clientes": lake.owned(CLIENTES)}
    gold_side = {"movimientos": held["movimientos"].where("id_mov % 10 <> 0"), "comisiones": held["comisiones"], "productos": lake.owned(PRODUCTOS)}
    compared = audit.reconcile_counts(held, gold_side)
    return compared.withColumns({name: F.col(name).cast("double") for name in ("valor_silver", "valor_gold")})


# --- Source checks ----------------------------------------------------------

KEYED = (CLIENTES, PRODUCTOS, OBLIGACIONES, SUCURSALES, COMISIONES)
INTENDED = {"duplicate_transactions": 3, "out_of_range_dates": 20, "inconsistent_transaction_fields": 30}


def key_checks(lake: Lake) -> DataFrame:
    return quality.check_keys({name: lake.source(name) for name in KEYED}, CFG.specs)


def fk_checks(lake: Lake) -> DataFrame:
    sources = {name: lake.source(name) for name in (*FACTS, CLIENTES, PRODUCTOS)}
    return quality.check_fk(sources, quality.fk_relations(FACTS, CLIENTES, PRODUCTOS))


def null_checks(lake: Lake) -> DataFrame:
    return quality.check_null_rates({name: lake.source(name) for name in CFG.specs}, CFG.specs)


def anomaly_checks(lake: Lake) -> DataFrame:
    return quality.check_anomalies(
        lake.owned(MOVIMIENTOS), CFG.start_date, CFG.end_date, CFG.allowed_channels, INTENDED
    )


def consistency_checks(lake: Lake) -> DataFrame:
    return quality.check_consistency(lake.owned(OBLIGACIONES))


def domain_checks(lake: Lake) -> DataFrame:
    return quality.check_domain(lake.owned(PRODUCTOS), "tip_prod", CFG.allowed_product_types)


query("dq_key_integrity")(key_checks)
query("dq_fk_membership")(fk_checks)
query("dq_null_rates")(null_checks)
query("dq_anomaly_counts")(anomaly_checks)
query("dq_business_consistency")(consistency_checks)
query("dq_domain_subset")(domain_checks)


@query("dq_full_row_duplicates")
def _(lake: Lake) -> DataFrame:
    return quality.count_full_duplicates(lake.owned(MOVIMIENTOS))


@query("dq_report")
def _(lake: Lake) -> DataFrame:
    out = lake.exported("export")  # one for both checks of files
    checks = {
        "keys": quality.as_checks(key_checks(lake), "llave", "tabla"),
        "references": quality.as_checks(fk_checks(lake), "referencia", "control"),
        "nulls": quality.as_checks(null_checks(lake), "nulos", "tabla", "columna"),
        "anomalies": quality.as_checks(anomaly_checks(lake), "anomalia", "anomalia"),
        "consistency": quality.as_checks(consistency_checks(lake), "consistencia", "control"),
        "domains": quality.check_subset(domain_checks(lake), "dominio.tip_prod"),
        "files": quality.as_checks(file_checks(lake, out), "archivo", "tabla", "formato"),
        "hashes": quality.as_checks(hash_checks(lake, out).withColumnRenamed("huellas_validas", "aprobado"), "huella", "table_name", "format"),
        "columns": lake.spark.createDataFrame(
            [(f"columnas.{name}", quality.check_columns(lake.owned(name), spec.columns)) for name, spec in CFG.specs.items()],
            "control string, aprobado boolean",
        ),
    }
    return quality.dq_report(lake.one_by_one(checks))
