"""Ingestion end to end: first load, an exact delta, a failure and its recovery."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from threading import Barrier

from conftest import SMOKE, rows
from pyspark.sql import functions as F

from tesora.config import APPEND_WATERMARK, CHANGE_TRACKING, CLIENTES, MOVIMIENTOS, PRODUCTOS, SPECS, RunContext
from tesora.plans import runner
from tesora.plans.catalogue import CFG, Lake
from tesora.sources import bronze, control, extract

AT = datetime(2024, 3, 1)


def initial_config(spark):
    data = [
        ("dbo", name.upper(), spec.strategy, spec.key if spec.strategy == CHANGE_TRACKING else None, spec.watermark_column, None, None, False, True, AT)
        for name, spec in SPECS.items()
    ]
    return spark.createDataFrame(data, control.CONFIG_SCHEMA)


def feed(spark, spec, changed=(), version=1):
    kind = spec.types[spec.key]
    changes = spark.createDataFrame([(k, version, "U") for k in changed], f"{spec.key} {kind}, version bigint, op string")
    return extract.ChangeFeed(changes, current_version=version, min_valid_version=1)


def copied(result):
    done = result.log.where("status = 'SUCCEEDED'")
    return {r["source_table"].lower(): r["rows_copied"] for r in done.collect()}


def test_load_delta_failure_recovery(spark, tmp_path):
    cfg = replace(CFG, root=str(tmp_path), specs=dict(SPECS))
    lake = Lake(spark, SMOKE)
    tables = {name: lake.source(name).select(*spec.columns) for name, spec in SPECS.items()}
    sources = {name: (lambda df=df: df) for name, df in tables.items()}
    tracked = {name: spec for name, spec in SPECS.items() if spec.strategy == CHANGE_TRACKING}

    first = runner.run_bronze(spark, sources, initial_config(spark), cfg, RunContext("L1", datetime(2024, 3, 1)), {n: feed(spark, s) for n, s in tracked.items()})
    assert copied(first) == {name: df.count() for name, df in tables.items()}
    assert first.errors.isEmpty() and first.log.where("status = 'STARTED'").count() == 6
    state = {r["source_table"].lower(): r for r in first.config.collect()}
    assert all(r["initial_load_completed"] for r in state.values())
    assert state[MOVIMIENTOS]["last_watermark_value"] == 999 and state[CLIENTES]["last_change_version"] == 1

    # One client changes and one movement is inserted: exactly those two rows are extracted.
    ident = tables[CLIENTES].agg(F.min("id_cli")).first()[0]
    grown = tables[MOVIMIENTOS].unionByName(tables[MOVIMIENTOS].limit(1).withColumn("id_mov", F.lit(900_000_001).cast("bigint")))
    sources = {**sources, MOVIMIENTOS: lambda: grown}
    feeds = {n: feed(spark, s, [ident] if n == CLIENTES else [], version=2) for n, s in tracked.items()}

    def broken():
        raise ConnectionError("source is down")

    second = runner.run_bronze(spark, {**sources, PRODUCTOS: broken}, first.config, cfg, RunContext("L2", datetime(2024, 3, 2)), feeds)
    counts = copied(second)
    assert counts[CLIENTES] == counts[MOVIMIENTOS] == 1 and sum(counts.values()) == 2 and PRODUCTOS not in counts
    error = second.errors.collect()
    assert [(e["source_table"].lower(), e["error_code"], e["error_message"]) for e in error] == [(PRODUCTOS, "ConnectionError", "source is down")]
    state = {r["source_table"].lower(): r for r in second.config.collect()}
    assert state[PRODUCTOS]["last_change_version"] == 1 and state[CLIENTES]["last_change_version"] == 2
    assert state[MOVIMIENTOS]["last_watermark_value"] == 900_000_001

    third = runner.run_bronze(spark, sources, second.config, cfg, RunContext("L3", datetime(2024, 3, 3)), feeds)
    assert sum(copied(third).values()) == 0 and third.errors.isEmpty()
    states = control.latest_state(spark.table("ctl.pipeline_run_log"))
    assert rows(states.groupBy("status").count()) == [("FAILED", 1), ("SUCCEEDED", 17)]
    assert spark.table("ctl.pipeline_error").count() == 1 and spark.table("ctl.ingestion_config").count() == 6
    assert bronze.read_bronze(spark, f"{cfg.root}/bronze", SPECS[CLIENTES]).count() == tables[CLIENTES].count() + 1
    spark.sql("DROP DATABASE ctl CASCADE")


def test_a_retried_run_keeps_what_landed_and_does_what_is_left(spark, tmp_path):
    cfg = replace(CFG, root=str(tmp_path), specs=dict(SPECS))
    lake = Lake(spark, SMOKE)
    tables = {name: lake.source(name).select(*spec.columns) for name, spec in SPECS.items()}
    sources = {name: (lambda df=df: df) for name, df in tables.items()}
    feeds = {n: feed(spark, s) for n, s in SPECS.items() if s.strategy == CHANGE_TRACKING}
    seen = []

    def broken():
        seen.append(spark.table("ctl.pipeline_run_log").where("status = 'STARTED'").count())
        raise ConnectionError("x" * 5000)

    run = RunContext("L1", AT)
    spark.sql("DROP DATABASE IF EXISTS ctl CASCADE")
    first = runner.run_bronze(spark, {**sources, PRODUCTOS: broken}, initial_config(spark), cfg, run, feeds)
    assert seen == [6]  # every start is stored before the first copy
    assert first.errors.first()["error_message"] == "x" * 5000
    again = runner.run_bronze(spark, sources, first.config, cfg, run, feeds)
    assert copied(again).keys() == {PRODUCTOS}
    for name, spec in SPECS.items():
        assert bronze.read_bronze(spark, f"{cfg.root}/bronze", spec).count() == tables[name].count(), name
    log = spark.table("ctl.pipeline_run_log")
    assert rows(log.groupBy("status").count()) == [("FAILED", 1), ("STARTED", 6), ("SUCCEEDED", 6)]
    assert rows(control.latest_state(log).groupBy("status").count()) == [("SUCCEEDED", 6)]
    done = log.where("status = 'SUCCEEDED'")
    assert done.where("rows_read <> rows_copied OR duration_seconds IS NULL").isEmpty()
    nothing = runner.run_bronze(spark, sources, again.config, cfg, run, feeds)
    assert nothing.log.isEmpty()

    # A crash after landing and before progress: the next run lands the same rows again, and none is lost.
    before = bronze.read_bronze(spark, f"{cfg.root}/bronze", SPECS[PRODUCTOS]).count()
    bronze.land_bronze(tables[PRODUCTOS], f"{cfg.root}/bronze", SPECS[PRODUCTOS], cfg, RunContext("L2", AT))
    landed = bronze.read_bronze(spark, f"{cfg.root}/bronze", SPECS[PRODUCTOS])
    assert landed.count() == 2 * before and landed.select("cod_prod").distinct().count() == before
    spark.sql("DROP DATABASE ctl CASCADE")


def test_append_strategy_belongs_to_keyed_tables():
    assert {n for n, s in SPECS.items() if s.strategy == APPEND_WATERMARK} == {MOVIMIENTOS}


def test_full_extract_reads_the_columns_of_the_table(spark, tmp_path):
    path = str(tmp_path / "p")
    lake = Lake(spark, SMOKE)
    lake.source(PRODUCTOS).withColumn("extra", F.lit(1)).write.parquet(path)
    reader = spark.read.format("parquet").option("path", path)
    assert extract.full_extract(reader, SPECS[PRODUCTOS]).columns == list(SPECS[PRODUCTOS].columns)


def test_tables_land_at_the_same_time(spark, tmp_path):
    cfg = replace(CFG, root=str(tmp_path), specs=dict(SPECS))
    lake, together = Lake(spark, SMOKE), Barrier(2, timeout=60)

    def slow(name):
        together.wait()  # breaks if the other table is not asked for meanwhile
        return lake.source(name).select(*SPECS[name].columns)

    config = initial_config(spark).where(F.col("source_table").isin(CLIENTES.upper(), PRODUCTOS.upper()))
    feeds = {name: feed(spark, SPECS[name]) for name in (CLIENTES, PRODUCTOS)}
    run = RunContext("L1", datetime(2024, 3, 1))
    result = runner.run_bronze(spark, {name: (lambda name=name: slow(name)) for name in feeds}, config, cfg, run, feeds, register=False)
    assert result.errors.isEmpty() and copied(result).keys() == {CLIENTES, PRODUCTOS}
    outcomes = result.log.where("status = 'SUCCEEDED'").orderBy("seq").select("source_table").collect()
    started = result.log.where("status = 'STARTED'").orderBy("seq").select("source_table").collect()
    assert outcomes == started
