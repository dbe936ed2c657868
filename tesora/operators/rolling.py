"""Per-client history of the preceding days and the outlier signal built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MEAN, DEVIATION, SAMPLES = "promedio_vr_mov_30d", "desv_vr_mov_30d", "cantidad_mov_30d"


# Cents are whole numbers of two limbs, high * LIMB + low, so that squares and products of limbs are exact in 64 bits.
LIMB = 10**9
# Below this sum of squared high limbs the whole sum of squares fits a decimal of 38 digits.
_FITS = 10**19

_STATE = {"_n": None, "_h": "_hi", "_l": "_lo", "_hh": "_hi * _hi", "_hl": "_hi * _lo", "_ll": "_lo * _lo"}


def daily_history(movements: DataFrame, client: str, day: str, amount: str, days: int) -> DataFrame:
    """Mean, sample deviation and count of the ``days`` before each (client, day).

    The frame leaves out the day itself, so the statistics depend on client and
    day only. A day's state is the count and five exact sums of limbs and their
    products; states add up. Days are therefore summed on the map side first,
    and one window adds the states of at most ``days`` rows, whatever the
    number of movements.

    The deviation is taken around the mean rounded to cents, m. The sums give
    the three sums of products of (limb - limb of m) exactly, and these the sum
    of squares around m. It is exact in a decimal unless the high limbs alone
    exceed 38 digits, and then they outweigh the rest so far that doubles
    cancel nothing. The step from m to the mean takes away half at most.
    """
    limbs = movements.select(client, day, (F.col(amount).cast("decimal(18,2)") * 100).cast("bigint").alias("_x")).select(
        client, day, F.expr(f"(_x - pmod(_x, {LIMB}L)) div {LIMB}L").alias("_hi"), F.expr(f"pmod(_x, {LIMB}L)").alias("_lo")
    )
    per_day = limbs.groupBy(client, day).agg(
        F.count("_lo").alias("_n"), *[F.sum(F.expr(f"cast({term} AS decimal(19,0))")).alias(name) for name, term in _STATE.items() if term]
    )
    before = Window.partitionBy(client).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    framed = per_day.select(client, day, *[F.sum(name).over(before).alias(name) for name in _STATE]).select(
        client, day, F.coalesce("_n", F.lit(0)).alias("_n"), *[F.col(name).cast("decimal(38,0)").alias(name) for name in _STATE if name != "_n"]
    )
    total = f"cast(_h * {LIMB} + _l AS decimal(34,0))"
    centred = (
        framed.withColumn("_s", F.expr(total))
        .withColumn("_m", F.expr("cast(round(_s / nullif(_n, 0)) AS bigint)"))
        .withColumns({"_mh": F.expr(f"(_m - pmod(_m, {LIMB}L)) div {LIMB}L"), "_ml": F.expr(f"pmod(_m, {LIMB}L)")})
        .withColumns(
            {
                "_p": F.expr("_hh - 2 * _mh * _h + _n * cast(_mh * _mh AS decimal(19,0))"),
                "_q": F.expr("_hl - _mh * _l - _ml * _h + _n * cast(_mh * _ml AS decimal(19,0))"),
                "_r": F.expr("_ll - 2 * _ml * _l + _n * cast(_ml * _ml AS decimal(19,0))"),
            }
        )
    )
    exact = F.expr(f"cast(_p * cast({LIMB**2} AS decimal(19,0)) + _q * {2 * LIMB}L + _r AS double)")
    rough = F.expr(f"cast(_p AS double) * {float(LIMB**2)} + cast(_q AS double) * {2.0 * LIMB} + cast(_r AS double)")
    around_m = F.when(F.expr(f"_p < {_FITS}BD"), exact).otherwise(rough)
    off = F.expr("cast(_s - _n * cast(_m AS decimal(19,0)) AS double)")
    squares = around_m - off * off / F.expr("nullif(_n, 0)")
    return centred.select(
        client,
        day,
        F.expr("cast(_s * 0.01BD / nullif(_n, 0) AS decimal(22,6))").alias(MEAN),
        F.when(F.col("_n") > 1, F.sqrt(squares / (F.col("_n") - 1)) / 100).alias(DEVIATION),
        F.col("_n").alias(SAMPLES),
    )


def attach_history(
    movements: DataFrame, history: DataFrame, in_period: str, client: str = "id_cli", day: str = "fec_mov"
) -> DataFrame:
    """Give each movement the history of its client and day; none outside the period."""
    joined = movements.join(history, [client, day], "left")
    return joined.withColumns({name: F.when(F.col(in_period), F.col(name)) for name in (MEAN, DEVIATION, SAMPLES)})


def flag_outlier(df: DataFrame, in_period: str, amount: str, sigmas: int = 3, min_samples: int = 2) -> DataFrame:
    """``ind_sospechoso``: above mean + sigmas * deviation, given enough history. Never null."""
    limit = F.col(MEAN) + F.coalesce(F.col(DEVIATION), F.lit(0.0)) * sigmas
    unusual = F.col(in_period) & (F.col(SAMPLES) >= min_samples) & (F.col(amount) > limit)
    return df.withColumn("ind_sospechoso", F.coalesce(unusual, F.lit(False)))


def round_history(df: DataFrame, scale: int = 2) -> DataFrame:
    """Publish rounded statistics; the flag was taken from the unrounded ones."""
    return df.withColumns({name: F.round(name, scale) for name in (MEAN, DEVIATION)})
