from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal
from statistics import mean, stdev

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tesora.operators import rolling

SCHEMA = "id_mov bigint, id_cli int, fec_mov date, vr_mov decimal(18,2), ok boolean"
DAY = date(2024, 3, 1)


def build(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    history = rolling.daily_history(df.where("ok"), "id_cli", "fec_mov", "vr_mov", 30)
    return rolling.flag_outlier(rolling.attach_history(df, history, "ok"), "ok", "vr_mov")


def expected(data):
    result = {}
    for ident, client, day, _, ok in data:
        if not ok or day is None:
            result[ident] = (None, None, None)
            continue
        past = [v for _, c, d, v, o in data if o and c == client and d is not None and v is not None and 1 <= (day - d).days <= 30]
        result[ident] = (
            mean(past) if past else None,
            stdev(map(float, past)) if len(past) > 1 else None,
            len(past),
        )
    return result


def check(spark, data):
    want = expected(data)
    for row in build(spark, data).collect():
        average, deviation, count = want[row["id_mov"]]
        assert row[rolling.SAMPLES] == count
        if average is None:
            assert row[rolling.MEAN] is None
        else:
            assert row[rolling.MEAN] == pytest.approx(average, abs=Decimal("0.0000006"))
        if deviation is None:
            assert row[rolling.DEVIATION] is None
        else:
            assert row[rolling.DEVIATION] == pytest.approx(deviation, rel=1e-9, abs=1e-6)


def test_frame_edges(spark):
    """The day itself is out, day -1 and day -30 are in, day -31 is out."""
    data = [(i, 1, DAY - timedelta(days=back), Decimal(value), True) for i, (back, value) in enumerate([(0, 5), (0, 6), (1, 10), (30, 20), (31, 999)])]
    found = {r["id_mov"]: r for r in build(spark, data).collect()}
    assert found[0][rolling.SAMPLES] == 2 and found[0][rolling.MEAN] == Decimal("15")
    check(spark, data)


def test_against_brute_force_with_a_hot_client(spark):
    rnd = random.Random(3)
    data = []
    for i in range(900):
        client = 1 if i % 3 == 0 else rnd.randrange(2, 40)
        value = None if rnd.random() < 0.03 else Decimal(rnd.randrange(1, 10**7)).scaleb(-2)
        data.append((i, client, DAY - timedelta(days=rnd.randrange(0, 80)), value, rnd.random() > 0.1))
    data.append((900, 1, None, Decimal("1.00"), False))
    check(spark, data)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 45), st.integers(0, 10**9)), min_size=1, max_size=40))
def test_against_brute_force_random(spark, entries):
    check(spark, [(i, c, DAY - timedelta(days=d), Decimal(v).scaleb(-2), True) for i, (c, d, v) in enumerate(entries)])


def test_same_as_the_window_over_movements(spark):
    rnd = random.Random(5)
    data = [(i, rnd.randrange(30), DAY - timedelta(days=rnd.randrange(90)), Decimal(rnd.randrange(1, 10**6)).scaleb(-2), rnd.random() > 0.2) for i in range(3000)]
    found = rolling.round_history(build(spark, data)).select("id_mov", rolling.MEAN, rolling.DEVIATION, rolling.SAMPLES, "ind_sospechoso")
    df = spark.createDataFrame(data, SCHEMA)
    before = Window.partitionBy("id_cli").orderBy(F.unix_date("fec_mov")).rangeBetween(-30, -1)
    direct = df.where("ok").select("id_mov", F.avg("vr_mov").over(before).alias("a"), F.stddev_samp("vr_mov").over(before).alias("s"), F.count("vr_mov").over(before).alias("n"))
    direct = df.join(direct, "id_mov", "left").select(
        "id_mov", F.round("a", 2).alias(rolling.MEAN), F.round("s", 2).alias(rolling.DEVIATION), F.col("n").alias(rolling.SAMPLES),
        F.coalesce(F.col("ok") & (F.col("n") >= 2) & (F.col("vr_mov") > F.col("a") + 3 * F.coalesce("s", F.lit(0))), F.lit(False)).alias("ind_sospechoso"),
    )
    assert found.exceptAll(direct).isEmpty() and direct.exceptAll(found).isEmpty()


@pytest.mark.parametrize(
    "amounts",
    [
        [Decimal(9 * 10**15) + Decimal(200_000) * (-1) ** i + i for i in range(40)],
        [Decimal("9999999999999999.99") - (i % 2) * 10**15 for i in range(40)],
        [Decimal("0.01") * (i % 3) for i in range(40)],
        [Decimal(10**10) * (i % 5) + Decimal("0.01") * (i % 2) for i in range(40)],
        [Decimal(-(10**10)) + Decimal("0.01") * (-1) ** i for i in range(40)],
        [Decimal("123.45")] * 40,
    ],
)
def test_one_formula_serves_all_sizes(spark, amounts):
    data = [(i, 1, DAY - timedelta(days=1 + i % 3), x, True) for i, x in enumerate(amounts)] + [(999, 1, DAY, Decimal(1), True)]
    row = build(spark, data).where("id_mov = 999").first()
    assert row[rolling.SAMPLES] == 40
    assert row[rolling.DEVIATION] == pytest.approx(float(stdev(amounts)), rel=1e-6, abs=1e-9)


def test_flag_needs_two_earlier_movements_and_is_never_null(spark):
    day = lambda back: DAY - timedelta(days=back)
    data = [(1, 1, day(2), Decimal(10), True), (2, 1, day(1), Decimal(10_000), True), (3, 1, day(0), Decimal(10_000_000), True),
            (4, 2, day(3), Decimal(5), True), (5, 2, day(2), Decimal(5), True), (6, 2, day(1), Decimal("5.01"), True),
            (7, 2, day(1), Decimal(5), True), (8, 2, day(1), Decimal(10**6), False)]
    flags = {r["id_mov"]: r["ind_sospechoso"] for r in build(spark, data).collect()}
    # One earlier movement is not a history; equal amounts have deviation 0 and
    # anything above them stands out; outside the period nothing does.
    assert flags == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True, 7: False, 8: False}


def test_window_sees_one_row_per_client_and_day(spark):
    df = spark.createDataFrame([(1, 1, DAY, Decimal(1), True)], SCHEMA)
    plan = rolling.daily_history(df, "id_cli", "fec_mov", "vr_mov", 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate")  # printed top down
