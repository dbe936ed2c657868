"""Standardisation and latest-version deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tesora.functions.columns import record_hash
from tesora.operators.skew import MAX_BUCKETS, salt, salted_lookup, salts_in_use


def standardize(df: DataFrame, uppercase: Sequence[str] = ()) -> DataFrame:
    """Trim every text column and upper-case the catalogue ones, in one projection."""

    def clean(name: str, is_text: bool) -> str:
        text = f"trim(`{name}`)" if is_text else f"`{name}`"
        return f"upper({text}) AS `{name}`" if name in uppercase else f"{text} AS `{name}`" if is_text else text

    return df.selectExpr(*[clean(f.name, isinstance(f.dataType, StringType)) for f in df.schema.fields])


def split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without). An empty text is a key."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def keep_latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of every non-null key.

    The rank filter lets Spark keep only the best row per key on each map task
    (WindowGroupLimit), so a key with very many copies reaches its reducer as
    one row per map task rather than as all copies.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(newest_first))
        .where("_rank = 1")
        .drop("_rank")
    )


def tag_latest(
    df: DataFrame, key: str, order: Sequence[str], flag: str = "_is_latest", buckets: int = 8
) -> DataFrame:
    """Every row, with a flag that is true for the latest row of its key.

    Copies must all survive here (they are audited), so ranking them in a
    window would put a whole group in one task. Instead an aggregate, which
    shrinks on the map side, finds the keys that repeat and the newest position
    of each; rows look their key up, spread by their own position, and compare.
    A key is looked up under the salts that its rows take, and carries its newest
    position only under the one where that lies: rows under the others are copies.
    ``order`` must be total within a key, as arrival order is.
    """
    buckets = min(buckets, MAX_BUCKETS)
    position = F.struct(*order)
    repeated = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(position).alias("_newest"), salts_in_use(order, buckets).alias("_salts"), F.count("*").alias("_copies"))
        .where("_copies > 1")
        .select(key, "_newest", "_salts", salt([F.col("_newest")[c] for c in order], buckets).alias("_home"))
    )
    found = salted_lookup(df, repeated, [key], order, buckets, in_use="_salts", at_home=("_home", "_newest"))
    latest = F.col(key).isNotNull() & (F.col("_home").isNull() | F.coalesce(F.col("_newest") == position, F.lit(False)))
    return found.withColumn(flag, latest).drop("_newest", "_home")


def dedupe_latest(df: DataFrame, key: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(kept rows, discarded copies); rows without a key are in neither."""
    tagged = tag_latest(df.where(F.col(key).isNotNull()), key, order)
    kept = keep_latest(df, key, order)
    return kept, tagged.where(~F.col("_is_latest")).drop("_is_latest")


def add_record_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("_record_hash", record_hash(df))
