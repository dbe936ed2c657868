"""Lookups that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

MAX_BUCKETS = 63  # salts in use are kept as the bits of a bigint
MAX_WORDS = 2**18  # words of a key set that are sent to every executor, some 16 MB; beyond it lookups are shuffled
_DIGITS = 18  # as many as surely fit a bigint


def salt(spread_by: Sequence[str | Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("int")


def salts_in_use(spread_by: Sequence[str], buckets: int) -> Column:
    """Aggregate: the salts that a group's rows take, as bits."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), salt(spread_by, buckets)))


def salted_lookup(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    buckets: int,
    how: str = "left",
    in_use: str | None = None,
    at_home: tuple[str, str] | None = None,
) -> DataFrame:
    """Join facts (left, or left_semi / left_anti) to a narrow lookup that is unique on ``keys``.

    Facts take a salt from a hash of ``spread_by`` (their own identity), the
    lookup is repeated once per salt, or, where its column ``in_use`` tells which
    salts the facts of a key take (:func:`salts_in_use`), for those alone: it then
    never has more rows than the facts. ``at_home`` names a column with a salt and
    one whose value is wanted under that salt only, and null elsewhere. The hash is repeatable, so a retried task
    produces the same rows. The lookup is shuffled on (keys, salt) whatever its
    own partitioning was, which is also the plan shape in which adaptive
    execution can split a still oversized partition. Spark judges a broadcast
    by the size before the repetition, so a lookup that passes its limit only
    once repeated is joined by a merge, whatever the session's settings are.
    """
    salted = facts.withColumn("_salt", salt(spread_by, buckets))
    salts = F.sequence(F.lit(0), F.lit(buckets - 1))
    if in_use is not None:
        salts = F.expr(f"filter(sequence(0, {buckets - 1}), s -> getbit({in_use}, s) = 1)")
    repeated = lookup.withColumn("_salt", F.explode(salts))
    if in_use is not None:
        repeated = repeated.drop(in_use)
    if at_home is not None:
        home, value = at_home
        repeated = repeated.withColumn(value, F.when(F.col("_salt") == F.col(home), F.col(value)))
    if estimated_bytes(lookup) * buckets > broadcast_limit(lookup):
        repeated = repeated.hint("merge")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def places(df: DataFrame, key: str) -> dict[str, Column] | None:
    """Where a key stands in a set kept as words of 64 neighbours: the columns that name its word, and its ``_bit`` there.

    Whole numbers stand by value. A text is its stem and the number it ends with; ``_width`` keeps leading zeros, and a
    text without such a number stands alone, so that two keys never share a place. None for keys of other types.
    """
    kind = df.schema[key].dataType
    if isinstance(kind, StringType):
        stem = f"rtrim('0123456789', `{key}`)"
        digits = f"substr(`{key}`, length({stem}) + 1)"
        number = F.expr(f"if(length({digits}) BETWEEN 1 AND {_DIGITS}, coalesce(try_cast({digits} AS bigint), -1L), -1L)")
        padded = f"if(startswith({digits}, '0') AND length({digits}) BETWEEN 2 AND {_DIGITS}, length({digits}), 0)"
        names = {"_stem": F.when(number < 0, F.col(key)).otherwise(F.expr(stem)), "_width": F.expr(padded)}
    elif isinstance(kind, IntegralType):
        number, names = F.col(key).cast("bigint"), {}
    else:
        return None
    return {**names, "_word": F.shiftright(number, 6), "_bit": number.bitwiseAND(F.lit(63)).cast("int")}


def key_words(keys: DataFrame, key: str) -> DataFrame | None:
    """A key set as words of 64 neighbours, a row each: numbered keys shrink by up to 64, others have one row each.

    None where that makes more than :data:`MAX_WORDS` rows: only their count comes to the driver.
    """
    at = places(keys, key)
    if at is None:
        return None
    names = [name for name in at if name != "_bit"]
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))).alias("_bits")
    words = keys.where(F.col(key).isNotNull()).select(*[column.alias(name) for name, column in at.items()]).groupBy(*names).agg(bits)
    return words if words.limit(MAX_WORDS + 1).count() <= MAX_WORDS else None


def mark_known(
    facts: DataFrame, lookup: DataFrame, words: DataFrame | None, key: str, flag: str, spread_by: Sequence[str], buckets: int
) -> DataFrame:
    """Add ``flag``: true where the key is in a set, else null.

    A set that is held as few words (:func:`key_words`) is sent whole, and no fact is shuffled, whatever its key;
    others are looked up by :func:`salted_lookup`.
    """
    if words is None:
        return salted_lookup(facts, lookup.withColumn(flag, F.lit(True)), [key], spread_by, buckets)
    at = places(facts, key)
    names = [name for name in at if name != "_bit"]
    found = facts.withColumns(at).join(F.broadcast(words), names, "left")
    return found.withColumn(flag, F.expr("if(getbit(_bits, _bit) = 1, true, null)")).drop(*at, "_bits")


def read_bytes(df: DataFrame) -> int:
    """What Spark's planner takes the sizes of the files and tables to be that a plan reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def estimated_bytes(df: DataFrame) -> int:
    """What Spark's planner takes a table's size to be."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
