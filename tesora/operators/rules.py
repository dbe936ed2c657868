"""Quality rules, reference checks and the quarantine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesora.config import (
    RULE_DUPLICATE,
    RULE_NO_CLIENT,
    RULE_NO_PRODUCT,
    RULE_NULL_KEY,
    LakeConfig,
    RunContext,
    TableSpec,
)
from tesora.operators.cleanse import keep_latest, standardize, tag_latest
from tesora.operators.skew import key_words, mark_known, salt

QUARANTINE_COLUMNS = (
    "run_id", "table_name", "primary_key_value", "quality_rules", "record_json",
    "batch_id", "ingestion_timestamp_utc", "source_file", "quarantined_at_utc",
)


@dataclass(frozen=True)
class Rule:
    """A business condition rows should meet.

    ``holds`` is true, false or null; only false is a violation. With a
    ``flag`` the outcome is also published as a column.
    """

    code: str
    holds: Column
    flag: str | None = None


def with_flags(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    flags = {rule.flag: rule.holds for rule in rules if rule.flag}
    return df.withColumns(flags) if flags else df


def rule_string(rules: Iterable[Rule]) -> Column:
    """Codes of the violated rules in order, joined by '|'; empty when clean."""
    codes = [F.when(~rule.holds, F.lit(rule.code)) for rule in rules]
    return F.concat_ws("|", *codes) if codes else F.lit("")


def map_domain(value: str, allowed: Sequence[str], default: str) -> Column:
    """The value where the domain has it, else (null included) the default."""
    return F.when(F.col(value).isin(*allowed), F.col(value)).otherwise(F.lit(default))


def existing_keys(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).select(key).distinct()


@dataclass(frozen=True)
class References:
    """Key sets that fact rows must point into."""

    clients: DataFrame
    products: DataFrame

    @classmethod
    def of(cls, clients: DataFrame, products: DataFrame) -> References:
        return cls(existing_keys(clients, "id_cli"), existing_keys(products, "cod_prod"))

    @cached_property
    def client_words(self) -> DataFrame | None:
        return key_words(self.clients, "id_cli")

    @cached_property
    def product_words(self) -> DataFrame | None:
        return key_words(self.products, "cod_prod")

    @property
    def sent(self) -> bool:
        """Whether both sets are sent whole, so that asking them shuffles no row."""
        return self.client_words is not None and self.product_words is not None

    def with_clients(self, df: DataFrame, spread_by: Sequence[str], buckets: int) -> DataFrame:
        return mark_known(df, self.clients, self.client_words, "id_cli", "_client_exists", spread_by, buckets)

    def with_products(self, df: DataFrame, spread_by: Sequence[str], buckets: int) -> DataFrame:
        return mark_known(df, self.products, self.product_words, "cod_prod", "_product_exists", spread_by, buckets)


def check_references(df: DataFrame, refs: References, spread_by: Sequence[str], buckets: int) -> DataFrame:
    """Add ``_client_exists`` and ``_product_exists``: true, or null when missing."""
    return refs.with_products(refs.with_clients(df, spread_by, buckets), spread_by, buckets)


def reference_rules() -> list[Rule]:
    return [
        Rule(RULE_NO_CLIENT, F.coalesce("_client_exists", F.lit(False))),
        Rule(RULE_NO_PRODUCT, F.coalesce("_product_exists", F.lit(False))),
    ]


def screen(
    df: DataFrame, spec: TableSpec, rules: Sequence[Rule], cfg: LakeConfig, refs: References | None = None
) -> DataFrame:
    """Rows that silver accepts, with their flags, when no audit trail is needed."""
    latest = keep_latest(standardize(df, spec.uppercase), spec.key, spec.order_columns)
    if refs is not None:
        checked = check_references(latest, refs, [spec.key], cfg.salt_buckets)
        latest = checked.where("_client_exists AND _product_exists").drop("_client_exists", "_product_exists")
    return with_flags(latest, rules)


def stage(
    df: DataFrame,
    spec: TableSpec,
    rules: Sequence[Rule],
    cfg: LakeConfig,
    refs: References | None = None,
    part: tuple[int, int] | None = None,
) -> DataFrame:
    """Every bronze row once, with what happened to it.

    Adds ``_quality_rules`` ('' when clean) and ``_accepted``. A row stops at
    the first stage that rejects it (missing key, superseded copy, missing
    reference); only rows that pass all three are held against the business
    rules, and those stay accepted. Columns a row never reached are null, so
    its JSON image holds what was known at the stage where it stopped.

    Rules are judged before anything is shuffled, so that a reader of outcomes
    alone (metrics, summary) carries them, and not the columns they look at.

    ``part`` (number, parts) takes the rows of one part of the keys, with all copies of each; rows without a key are in one part.
    """
    standard = standardize(df, spec.uppercase)
    if part is not None:
        standard = standard.where(salt([spec.key], part[1]) == part[0])
    held = [f"_holds_{i}" for i in range(len(rules))]
    judged = standard.withColumns({name: rule.holds for name, rule in zip(held, rules)}) if held else standard
    rules = [replace(rule, holds=F.col(name)) for name, rule in zip(held, rules)]
    tagged = tag_latest(judged, spec.key, spec.order_columns)
    current = F.col(spec.key).isNotNull() & F.col("_is_latest")
    if refs is not None:
        tagged = check_references(tagged, refs, [spec.key, *spec.order_columns], cfg.salt_buckets)
        tagged = tagged.withColumns(
            {name: F.when(current, F.col(name)) for name in ("_client_exists", "_product_exists")}
        )
        reference_codes = rule_string(reference_rules())
    else:
        reference_codes = F.lit("")

    tagged = tagged.withColumn("_reference_rules", F.when(current, reference_codes))
    accepted = current & (F.col("_reference_rules") == "")
    flagged = tagged.withColumns({r.flag: F.when(accepted, r.holds) for r in rules if r.flag}) if any(
        r.flag for r in rules
    ) else tagged
    outcome = (
        F.when(F.col(spec.key).isNull(), F.lit(RULE_NULL_KEY))
        .when(~F.col("_is_latest"), F.lit(RULE_DUPLICATE))
        .when(F.col("_reference_rules") != "", F.col("_reference_rules"))
        .otherwise(rule_string(rules))
    )
    staged = flagged.withColumns({"_quality_rules": outcome, "_accepted": accepted})
    if refs is not None:
        # An accepted row's reference markers are always true; only rejected
        # rows carry them into the quarantine image.
        staged = staged.withColumns(
            {name: F.when(~F.col("_accepted"), F.col(name)) for name in ("_client_exists", "_product_exists")}
        )
    return staged.drop("_is_latest", "_reference_rules", *held)


STAGE_COLUMNS = ("_quality_rules", "_accepted", "_client_exists", "_product_exists")


def accepted_rows(staged: DataFrame) -> DataFrame:
    return staged.where("_accepted").drop(*STAGE_COLUMNS)


def to_quarantine(
    df: DataFrame, table: str, key: str, run: RunContext, hidden: Sequence[str] = ("_accepted", "_row_index")
) -> DataFrame:
    """Rows with a non-empty ``_quality_rules``, in the one quarantine schema."""
    image = [c for c in df.columns if c != "_quality_rules" and c not in hidden]

    def technical(name: str, kind: str) -> Column:
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)

    return df.where(F.col("_quality_rules") != "").select(
        F.lit(run.run_id).alias("run_id"),
        F.lit(table).alias("table_name"),
        F.col(key).cast("string").alias("primary_key_value"),
        F.col("_quality_rules").alias("quality_rules"),
        F.to_json(F.struct(*image)).alias("record_json"),
        technical("_batch_id", "string").alias("batch_id"),
        technical("_ingestion_timestamp_utc", "timestamp").alias("ingestion_timestamp_utc"),
        technical("_source_file", "string").alias("source_file"),
        F.lit(run.as_of).cast("timestamp").alias("quarantined_at_utc"),
    )


def quarantine_all(staged: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], run: RunContext) -> DataFrame:
    """One quarantine over all staged tables."""
    parts = [to_quarantine(df, name, specs[name].key, run) for name, df in staged.items()]
    return reduce(DataFrame.unionByName, parts)


def rule_summary(quarantine: DataFrame) -> DataFrame:
    """Rejections per table and single rule."""
    return (
        quarantine.select("table_name", F.explode(F.split("quality_rules", r"\|")).alias("quality_rule"))
        .groupBy("table_name", "quality_rule")
        .agg(F.count("*").alias("rejected_rows"))
    )


def stage_metrics(staged: Mapping[str, DataFrame], run: RunContext) -> DataFrame:
    """Rows read, accepted and quarantined per table, in one pass over each staged table."""
    parts = [
        df.agg(
            F.count("*").alias("bronze_rows"),
            F.count_if("_accepted").alias("silver_rows"),
            F.count_if(F.col("_quality_rules") != "").alias("quarantined_rows"),
        ).select(
            F.lit(run.run_id).alias("run_id"),
            F.lit(name).alias("table_name"),
            "bronze_rows",
            "silver_rows",
            "quarantined_rows",
            F.lit(run.as_of).cast("timestamp").alias("processed_at_utc"),
        )
        for name, df in staged.items()
    ]
    return reduce(DataFrame.unionByName, parts)
