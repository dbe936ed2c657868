"""Compacted landings: same rows, few files, and only those in range are opened."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tesora.config import SUCURSALES, MOVIMIENTOS, SPECS, RunContext
from tesora.plans.catalogue import CFG
from tesora.sources import bronze, snapshots

SPEC = replace(SPECS[MOVIMIENTOS], name="tb_few", types={"id_mov": "bigint", "id_cli": "int"}, key="id_mov")
FIRST = date(2023, 12, 20)


def land(spark, root, day, n=4):
    df = spark.range(n).selectExpr(f"id * 1000 + {(day - FIRST).days} AS id_mov", "cast(id AS int) AS id_cli")
    bronze.land_bronze(df, root, SPEC, CFG, RunContext(f"R{day}", datetime(day.year, day.month, day.day, 3)))


def same(a, b):
    names = sorted(a.columns)
    return sorted(a.columns) == sorted(b.columns) and rows(a, *names) == rows(b, *names)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    for i in range(24):
        land(spark, root, FIRST + timedelta(days=i))
    return root


def test_reads_open_only_what_is_in_range(spark, lake):
    at = lambda i: FIRST + timedelta(days=i)
    whole = bronze.read_bronze(spark, lake, SPEC)
    assert same(bronze.read_compacted(spark, lake, SPEC), whole)  # nothing compacted yet
    bronze.compact(spark, lake, SPEC, at(14), rows_per_file=16)
    bronze.compact(spark, lake, SPEC, at(20), rows_per_file=1000)
    assert bronze.compact(spark, lake, SPEC, at(20)) is None
    assert same(bronze.read_compacted(spark, lake, SPEC), whole)

    part = bronze.read_compacted(spark, lake, SPEC, at(2), at(6))
    assert same(part, bronze.read_bronze(spark, lake, SPEC, at(2), at(6))) and part.count() == 20
    assert len(part.inputFiles()) <= 3 and all("_compacted" in f for f in part.inputFiles())
    assert same(bronze.read_compacted(spark, lake, SPEC, at(18), at(22)), bronze.read_bronze(spark, lake, SPEC, at(18), at(22)))
    late = bronze.read_compacted(spark, lake, SPEC, at(21))
    assert late.count() == 12 and not any("_compacted" in f for f in late.inputFiles())
    assert bronze.read_compacted(spark, lake, SPEC, date(2030, 1, 1)).count() == 0

    keyed = bronze.read_compacted(spark, lake, SPEC, until=at(13), keys=(0, 3))
    assert same(keyed, whole.where("id_mov BETWEEN 0 AND 3")) and len(keyed.inputFiles()) < len(bronze.read_compacted(spark, lake, SPEC, until=at(13)).inputFiles())


def test_a_compacted_day_is_closed(spark, lake):
    with pytest.raises(bronze.ClosedDay):
        land(spark, lake, FIRST + timedelta(days=3))
    land(spark, lake, FIRST + timedelta(days=30))
    assert same(bronze.read_compacted(spark, lake, SPEC), bronze.read_bronze(spark, lake, SPEC))


def test_a_failure_before_the_commit_loses_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i in range(3):
        land(spark, root, FIRST + timedelta(days=i))

    def fails(*args, **kwargs):
        raise OSError("lost")

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(snapshots.Layer, "commit", fails)
        bronze.compact(spark, root, SPEC, FIRST + timedelta(days=2))
    assert same(bronze.read_compacted(spark, root, SPEC), bronze.read_bronze(spark, root, SPEC))
    assert bronze.compact(spark, root, SPEC, FIRST + timedelta(days=2)).seq == 1
    read = bronze.read_compacted(spark, root, SPEC)
    assert same(read, bronze.read_bronze(spark, root, SPEC)) and read.where(F.col("_source_file").contains("_compacted")).isEmpty()


def test_text_keys_and_null_keys(spark, tmp_path):
    spec = replace(SPECS[SUCURSALES], types={"cod_suc": "string", "nom_suc": "string"})
    df = spark.createDataFrame([("S1", "a"), (None, "b"), ("S9", None)], "cod_suc string, nom_suc string")
    bronze.land_bronze(df, str(tmp_path), spec, CFG, RunContext("R", datetime(2024, 1, 1)))
    bronze.compact(spark, str(tmp_path), spec, date(2024, 1, 2))
    assert same(bronze.read_compacted(spark, str(tmp_path), spec), bronze.read_bronze(spark, str(tmp_path), spec))
    assert rows(bronze.read_compacted(spark, str(tmp_path), spec, keys=("S1", "S2")), "cod_suc") == [("S1",)]
