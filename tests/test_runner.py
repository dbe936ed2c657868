from __future__ import annotations

import os
import time
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal
from functools import reduce

import pytest
from conftest import SMOKE, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.config import CLIENTES, COMISIONES, MOVIMIENTOS, PRODUCTOS, SPECS, RunContext
from tesora.operators import audit
from tesora.plans import runner, silver
from tesora.plans.catalogue import CFG, Lake
from tesora.sources import bronze


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Source tables landed in two batches, then two identical runs."""
    root = str(tmp_path_factory.mktemp("lake"))
    cfg = replace(CFG, root=root, specs=dict(SPECS))
    source = Lake(spark, SMOKE)
    for batch in (1, 2):
        run = RunContext(f"LOAD-{batch}", datetime(2024, 2, batch), str(batch))
        for name, spec in SPECS.items():
            df = source.source(name)
            part = df.where(F.col("_batch_id") == batch) if "_batch_id" in df.columns else df.where(F.lit(batch == 1))
            bronze.land_bronze(part.select(*spec.columns), f"{root}/bronze", spec, cfg, run)
    runs = [RunContext(f"RUN-{i}", datetime(2024, 2, 5) + timedelta(days=i)) for i in (1, 2)]
    results = [runner.run_lake(spark, cfg, run) for run in runs]
    return cfg, runs, results


def test_published_tables_and_metrics(spark, lake):
    cfg, runs, results = lake
    metrics = spark.table("quality.silver_run_metrics")
    assert metrics.count() == 12 and spark.table("gold.gold_run_metrics").count() == 20
    held = {r["table_name"]: r for r in metrics.where("run_id = 'RUN-2'").collect()}
    for name in cfg.specs:
        assert spark.table(f"silver.{name}").count() == held[name]["silver_rows"] > 0
    rejected = spark.table("quality.rejected_records")
    assert rejected.count() == sum(r["quarantined_rows"] for r in held.values())
    assert {r["run_id"] for r in rejected.select("run_id").distinct().collect()} == {"RUN-2"}
    summary = spark.table("quality.rule_summary")
    assert summary.agg(F.sum("rejected_rows")).first()[0] >= rejected.count()
    assert spark.table("gold.kpi_resumen_bancario").first()["run_id"] == "RUN-2"


def test_movements_match_the_direct_build(spark, lake):
    direct = Lake(spark, SMOKE).silver[MOVIMIENTOS]
    columns = [c for c in direct.columns if not c.startswith("_")]
    published = spark.table(f"silver.{MOVIMIENTOS}").select(*columns)
    assert published.exceptAll(direct.select(*columns)).isEmpty() and direct.select(*columns).exceptAll(published).isEmpty()


def test_two_runs_agree(spark, lake):
    same = audit.idempotence(spark.table("gold.gold_run_metrics"))
    assert same.count() == 10 and same.where("NOT resultado_idempotente").isEmpty()
    latest = audit.latest_runs(spark.table("quality.silver_run_metrics")).collect()
    assert [r["run_id"] for r in latest] == ["RUN-2", "RUN-1"]
    assert latest[0]["total_bronze"] == latest[1]["total_bronze"] and latest[0]["tablas_procesadas"] == 6


def test_gold_has_no_personal_columns(spark, lake):
    _, _, results = lake
    found = audit.pii_scan({"gold": results[-1][1].tables}).first()
    assert found["columnas_personales_expuestas"] == 0 and found["columnas_cuenta_protegidas"] == 1


def test_failed_audit_publishes_nothing(spark, lake):
    """A run without products empties silver facts; the previous snapshot stays."""
    cfg, _, _ = lake
    before = rows(spark.table(f"silver.{MOVIMIENTOS}"), "id_mov")
    landed = runner.landed(spark, cfg)
    landed[PRODUCTOS] = landed[PRODUCTOS].limit(0)
    with pytest.raises(audit.AuditError, match="empty silver tables"):
        runner.run_silver(spark, landed, cfg, RunContext("BROKEN", datetime(2024, 3, 1)))
    assert rows(spark.table(f"silver.{MOVIMIENTOS}"), "id_mov") == before
    assert spark.table("quality.silver_run_metrics").where("run_id = 'BROKEN'").isEmpty()


def test_a_failed_repetition_of_the_published_run_changes_nothing(spark, lake):
    cfg, runs, _ = lake
    before = rows(spark.table(f"silver.{MOVIMIENTOS}"), "id_mov")
    metrics = rows(spark.table("quality.silver_run_metrics"))
    landed = runner.landed(spark, cfg)
    with pytest.raises(audit.AuditError, match="empty silver tables"):
        runner.run_silver(spark, {**landed, PRODUCTOS: landed[PRODUCTOS].limit(0)}, cfg, runs[-1])
    assert rows(spark.table(f"silver.{MOVIMIENTOS}"), "id_mov") == before
    runner.run_silver(spark, landed, cfg, runs[-1])  # a whole repetition: same contents, no second metrics
    assert rows(spark.table(f"silver.{MOVIMIENTOS}"), "id_mov") == before
    assert rows(spark.table("quality.silver_run_metrics")) == metrics


def test_superseded_client_version_is_replaced(spark, lake):
    cfg, _, _ = lake
    spec = SPECS[CLIENTES]
    old = spark.table(f"silver.{CLIENTES}").orderBy("id_cli").limit(1)
    ident = old.first()["id_cli"]
    changed = old.select(*spec.columns).withColumn("estado_cli", F.lit("cerrado"))
    bronze.land_bronze(changed, f"{cfg.root}/bronze", spec, cfg, RunContext("LOAD-3", datetime(2024, 2, 9)))
    result = runner.run_silver(spark, runner.landed(spark, cfg), cfg, RunContext("RUN-3", datetime(2024, 2, 10)), register=False)
    assert result.tables[CLIENTES].where(F.col("id_cli") == ident).first()["estado_cli"] == "CERRADO"
    metrics = {r["table_name"]: r for r in result.metrics.collect()}[CLIENTES]
    assert metrics["quarantined_rows"] == 1 and metrics["bronze_rows"] == metrics["silver_rows"] + 1


def test_record_hashes_are_written_in_half_their_length(spark, cfg, run):
    """A hash has 64 letters of 16 kinds: 32 bytes of content. Written versions must not spend 64 on it."""
    hashes = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("_record_hash"))
    versions = runner.Versions(spark, cfg, run, "silver")
    held = versions.write(hashes, "silver", "hashes")
    size = spark.read.format("binaryFile").load(versions.written["silver.hashes"][0]).where("path LIKE '%.parquet'").agg(F.sum("length")).first()[0]
    assert held.exceptAll(hashes).isEmpty() and held.count() == 20_000
    assert size < 20_000 * 64 * 0.7


def test_a_fact_staged_in_parts_has_the_rows_of_the_whole(spark, monkeypatch):
    """Copies, rows without a key and unknown references; the parts' keys are apart."""
    at = datetime(2024, 2, 1)
    text = "id_comision bigint, id_cli int, cod_prod string, fec_cobro date, vr_comision decimal(18,2), tip_comision string, estado_cobro string"
    rows_of = [(k % 40 if k % 7 else None, k % 9, f"p{k % 5} ", at.date(), Decimal(k - 20), "x", "COBRADA", at + timedelta(days=k), "f", k) for k in range(120)]
    fees = spark.createDataFrame(rows_of, f"{text}, _ingestion_timestamp_utc timestamp, _source_file string, _row_index bigint")
    bronze_rows = {
        COMISIONES: fees,
        CLIENTES: spark.createDataFrame([(k,) for k in range(6)], "id_cli int"),
        PRODUCTOS: spark.createDataFrame([("P1",), ("P2",), ("P4",)], "cod_prod string"),
    }
    cfg = replace(CFG, specs=dict(SPECS))
    monkeypatch.setattr(silver, "PART_BYTES", 2**63)
    whole = silver.stage_parts(bronze_rows, COMISIONES, cfg)
    monkeypatch.setattr(silver, "PART_BYTES", 0)
    parts = silver.stage_parts(bronze_rows, COMISIONES, cfg)
    assert len(whole) == 1 and len(parts) == silver.PARTS
    assert rows(reduce(DataFrame.unionByName, parts)) == rows(whole[0]) and whole[0].count() == 120
    keys = [{r[0] for r in part.select("id_comision").distinct().collect()} for part in parts]
    assert sum(map(len, keys)) == len(set().union(*keys)) and sum(None in k for k in keys) == 1


def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path):
    local = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def files():
        return {name for folder in local for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    versions = runner.Versions(spark, replace(CFG, root=str(tmp_path)), RunContext("R", datetime(2024, 2, 1)), "silver")
    before = files()
    parts = [spark.range(20_000).selectExpr(f"id % 5003 + {5003 * k} AS k").groupBy("k").count() for k in (0, 1)]
    held = versions.write(parts[0], "silver", "t", parts[1])
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and held.count() == 10_006
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
