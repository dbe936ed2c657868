from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tesora.functions import columns as c


def one(spark, column, **values):
    schema = ", ".join(f"{k} {kind}" for k, (kind, _) in values.items())
    df = spark.createDataFrame([tuple(v for _, v in values.values())], schema)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("age", "band"),
    [(17, "18-24"), (24, "18-24"), (25, "25-34"), (34, "25-34"), (35, "35-44"), (54, "45-54"), (64, "55-64"), (65, "65+"), (None, "65+")],
)
def test_age_bands(spark, age, band):
    assert one(spark, c.bucket("a", c.AGE_EDGES, c.AGE_LABELS), a=("int", age)) == band


@pytest.mark.parametrize(
    ("score", "band"),
    [(None, "SIN_INFORMACION"), (499, "MUY_BAJO"), (500, "BAJO"), (649, "BAJO"), (650, "MEDIO"), (749, "MEDIO"), (750, "ALTO")],
)
def test_score_bands(spark, score, band):
    assert one(spark, c.bucket("a", c.SCORE_EDGES, c.SCORE_LABELS, null_label=c.SCORE_UNKNOWN), a=("int", score)) == band


@pytest.mark.parametrize(
    ("days", "band"),
    [(-1, "AL_DIA"), (0, "AL_DIA"), (1, "MORA_1_30"), (30, "MORA_1_30"), (31, "MORA_31_60"), (60, "MORA_31_60"),
     (90, "MORA_61_90"), (91, "MORA_MAYOR_90"), (None, "MORA_MAYOR_90")],
)
def test_arrears_bands(spark, days, band):
    assert one(spark, c.bucket("a", c.ARREARS_EDGES, c.ARREARS_LABELS, inclusive=True), a=("int", days)) == band


@pytest.mark.parametrize(
    ("birth", "cutoff", "age"),
    [
        (date(2004, 2, 29), date(2026, 2, 28), 22),  # month ends match
        (date(2004, 2, 29), date(2026, 2, 27), 21),
        (date(2000, 5, 10), date(2024, 5, 10), 24),
        (date(2000, 5, 11), date(2024, 5, 10), 23),
        (None, date(2024, 5, 10), None),
    ],
)
def test_age_at_cutoff(spark, birth, cutoff, age):
    assert one(spark, c.age_at("b", cutoff), b=("date", birth)) == age


def test_date_key(spark):
    assert one(spark, c.date_key("d"), d=("date", date(2024, 3, 7))) == 20240307
    assert one(spark, c.date_key("d"), d=("date", None)) is None


def test_percentage_of_nothing(spark):
    assert one(spark, c.percentage("p", "w"), p=("int", 0), w=("int", 0)) is None
    assert one(spark, c.percentage("p", "w", 0.0), p=("int", 0), w=("int", 0)) == 0.0
    assert one(spark, c.percentage("p", "w", 0.0), p=("int", 1), w=("int", 3)) == 33.33


@pytest.mark.parametrize(
    ("days", "hits", "level"),
    [(91, 0, "ALTO"), (0, 10, "ALTO"), (90, 9, "MEDIO"), (31, 0, "MEDIO"), (30, 0, "BAJO"), (0, 1, "MEDIO"), (0, 0, "BAJO")],
)
def test_alert_level(spark, days, hits, level):
    assert one(spark, c.alert_level("d", "h"), d=("int", days), h=("int", hits)) == level


def test_record_hash_ignores_technical_columns_and_order(spark):
    df = spark.createDataFrame([(1, None, "a", "f1")], "b int, a string, c string, _source_file string")
    text = "<NULL>||1||a"
    expected = spark.range(1).select(F.sha2(F.lit(text), 256).alias("x")).first()["x"]
    assert df.select(c.record_hash(df).alias("x")).first()["x"] == expected
    swapped = df.select("c", "_source_file", "b", "a")
    assert swapped.select(c.record_hash(swapped).alias("x")).first()["x"] == expected
