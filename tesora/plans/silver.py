"""The six silver tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.config import (
    CLIENTES,
    COMISIONES,
    MOVIMIENTOS,
    OBLIGACIONES,
    PRODUCTOS,
    RULE_AMOUNTS,
    RULE_BAD_CHANNEL,
    RULE_DATES,
    RULE_NEGATIVE_FEE,
    RULE_OUT_OF_PERIOD,
    UNKNOWN_CHANNEL,
    LakeConfig,
    RunContext,
    TableSpec,
)
from tesora.operators.cleanse import add_record_hash, keep_latest, standardize
from tesora.operators.rolling import attach_history, daily_history, flag_outlier, round_history
from tesora.operators.rules import References, Rule, accepted_rows, check_references, map_domain, screen, stage, with_flags
from tesora.operators.skew import read_bytes

IN_PERIOD = "ind_fecha_rango_valido"
PARTS, PART_BYTES = 4, 2**26  # facts read from more bytes are staged in so many parts


def rules_for(table: str, cfg: LakeConfig) -> list[Rule]:
    """Business rules of a table, in the order their codes are reported."""
    if table == OBLIGACIONES:
        approved, paid_out, balance = F.col("vr_aprobado"), F.col("vr_desembolsado"), F.col("sdo_capital")
        descending = (approved >= paid_out) & (paid_out >= balance) & (balance >= 0)
        return [
            Rule(RULE_AMOUNTS, descending, flag="ind_montos_consistentes"),
            Rule(RULE_DATES, F.col("fec_venc") > F.col("fec_desembolso"), flag="ind_fechas_consistentes"),
        ]
    if table == COMISIONES:
        return [Rule(RULE_NEGATIVE_FEE, F.col("vr_comision") >= 0)]
    if table == MOVIMIENTOS:
        in_period = F.col("fec_mov").between(F.lit(cfg.start_date), F.lit(cfg.end_date))
        return [
            Rule(RULE_OUT_OF_PERIOD, in_period, flag=IN_PERIOD),
            Rule(RULE_BAD_CHANNEL, F.col("cod_canal").isin(*cfg.allowed_channels), flag="ind_canal_valido"),
        ]
    return []


def references(bronze: Mapping[str, DataFrame], cfg: LakeConfig) -> References:
    """Keys facts may point at. Existence needs no deduplication, only standard text."""
    keys = [
        standardize(bronze[name].select(cfg.specs[name].key), cfg.specs[name].uppercase) for name in (CLIENTES, PRODUCTOS)
    ]
    return References.of(*keys)


def map_channel(movements: DataFrame, cfg: LakeConfig) -> DataFrame:
    """Keep the channel as received and publish it mapped to the domain."""
    return movements.withColumns(
        {
            "cod_canal_original": F.col("cod_canal"),
            "cod_canal": map_domain("cod_canal", cfg.allowed_channels, UNKNOWN_CHANNEL),
        }
    )


def movement_history(movements: DataFrame, cfg: LakeConfig) -> DataFrame:
    return daily_history(movements.where(IN_PERIOD), "id_cli", "fec_mov", "vr_mov", cfg.lookback_days)


def with_history(movements: DataFrame, history: DataFrame, cfg: LakeConfig) -> DataFrame:
    attached = attach_history(movements, history, IN_PERIOD)
    flagged = flag_outlier(attached, IN_PERIOD, "vr_mov", cfg.outlier_sigmas, cfg.outlier_min_history)
    return round_history(flagged)


def history_from_bronze(bronze: DataFrame, refs: References, spec: TableSpec, cfg: LakeConfig) -> DataFrame:
    """Movement history straight from bronze, for plans without a staged table.

    A movement counts when its client and product exist. A missing client has
    no accepted movement to attach a history to, so only the product needs
    checking, and the scan reads five columns.
    """
    latest = keep_latest(
        standardize(bronze.select(spec.key, *spec.order_columns, "id_cli", "cod_prod", "fec_mov", "vr_mov"), spec.uppercase),
        spec.key,
        spec.order_columns,
    )
    known = refs.with_products(latest, [spec.key], cfg.salt_buckets).where("_product_exists").drop("_product_exists")
    return movement_history(with_flags(known, rules_for(MOVIMIENTOS, cfg)[:1]), cfg)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop("_row_index", *[c for c in df.columns if c.startswith("_ord")])


def finish(df: DataFrame, run: RunContext | None = None) -> DataFrame:
    """Add the record hash, and the processing time when part of a run."""
    hashed = add_record_hash(drop_internal(df))
    return hashed if run is None else hashed.withColumn("_silver_processed_at_utc", F.lit(run.as_of).cast("timestamp"))


def screened(
    bronze: Mapping[str, DataFrame], table: str, cfg: LakeConfig, refs: References | None = None
) -> DataFrame:
    """Accepted rows of a table with flags, before movement history."""
    spec = cfg.specs[table]
    if spec.is_fact:
        refs = refs or references(bronze, cfg)
    df = screen(bronze[table], spec, rules_for(table, cfg), cfg, refs if spec.is_fact else None)
    return map_channel(df, cfg) if table == MOVIMIENTOS else df


def build_table(
    bronze: Mapping[str, DataFrame],
    table: str,
    cfg: LakeConfig,
    run: RunContext | None = None,
    refs: References | None = None,
) -> DataFrame:
    """One silver table from bronze frames, as a single lazy plan."""
    if cfg.specs[table].is_fact:
        refs = refs or references(bronze, cfg)
    df = screened(bronze, table, cfg, refs)
    if table == MOVIMIENTOS:
        df = with_history(df, history_from_bronze(bronze[table], refs, cfg.specs[table], cfg), cfg)
    return finish(df, run)


def narrow_fact(
    bronze: Mapping[str, DataFrame], table: str, columns: Sequence[str], cfg: LakeConfig, refs: References
) -> DataFrame:
    """Some columns of a silver fact, of those that it has before movement history.

    Readers that do not want the references (counts, dates) need not carry them: where asking for them shuffles no row,
    they are asked before copies are ranked. Rows without them still travel, since they may supersede older copies.
    """
    if not refs.sent or {"id_cli", "cod_prod"} & set(columns):
        return screened(bronze, table, cfg, refs).select(*columns)
    spec = cfg.specs[table]
    checked = check_references(standardize(bronze[table], spec.uppercase), refs, [spec.key], cfg.salt_buckets)
    known = F.coalesce(F.col("_client_exists") & F.col("_product_exists"), F.lit(False)).alias("_known")
    wanted = [c for c in columns if c not in (spec.key, *spec.order_columns)]
    ranked = with_flags(checked, rules_for(table, cfg)).select(spec.key, *spec.order_columns, known, *wanted)
    return keep_latest(ranked, spec.key, spec.order_columns).where("_known").select(*columns)


def build_silver(
    bronze: Mapping[str, DataFrame], cfg: LakeConfig, run: RunContext | None = None, tables: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    refs = references(bronze, cfg)
    return {name: build_table(bronze, name, cfg, run, refs) for name in (tables or cfg.specs)}


def stage_table(
    bronze: Mapping[str, DataFrame],
    table: str,
    cfg: LakeConfig,
    refs: References | None = None,
    part: tuple[int, int] | None = None,
) -> DataFrame:
    """Every bronze row of a table (or of a part of its keys) with its outcome, for silver and quarantine alike."""
    spec = cfg.specs[table]
    if spec.is_fact:
        refs = refs or references(bronze, cfg)
    staged = stage(bronze[table], spec, rules_for(table, cfg), cfg, refs if spec.is_fact else None, part)
    if table == MOVIMIENTOS:
        staged = staged.withColumn("cod_canal_original", F.when(F.col("_accepted"), F.col("cod_canal")))
    return staged


def stage_parts(
    bronze: Mapping[str, DataFrame], table: str, cfg: LakeConfig, refs: References | None = None
) -> list[DataFrame]:
    """:func:`stage_table` in parts by key that together hold each row once. Written one after the other, only the shuffle
    files of one part are there at a time; the input is read once for each part."""
    if not cfg.specs[table].is_fact or read_bytes(bronze[table]) <= PART_BYTES:
        return [stage_table(bronze, table, cfg, refs)]
    return [stage_table(bronze, table, cfg, refs, (number, PARTS)) for number in range(PARTS)]


def silver_from_stage(
    staged: DataFrame, table: str, cfg: LakeConfig, run: RunContext | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """The silver table held in a staged one. The staged table is meant to be
    written first: movements are read twice here, once for their history.
    Rows are sorted by ``order`` within partitions, before they carry their hash."""
    df = accepted_rows(staged)
    if table == MOVIMIENTOS:
        df = map_channel(df.drop("cod_canal_original"), cfg)
        df = with_history(df, movement_history(df, cfg), cfg)
    return finish(df.sortWithinPartitions(*order) if order else df, run)
