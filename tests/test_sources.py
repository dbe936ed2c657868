from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import SMOKE, rows
from pyspark.sql import functions as F

from tesora.config import APPEND_WATERMARK, CHANGE_TRACKING, CLIENTES, COMISIONES, LOAD_ORDER, MOVIMIENTOS, PRODUCTOS, SPECS, RunContext
from tesora.operators import quality
from tesora.plans import catalogue
from tesora.sources import bronze, control, extract, sinks
from tesora.streaming.alerts import failure_alerts
from tesora.streaming.landing import stream_bronze

FEES = SPECS[COMISIONES]


def fees(spark, ids):
    return spark.createDataFrame([(i, 1, "P1", date(2024, 1, 1), Decimal(i), None, "COBRADA") for i in ids], FEES.ddl)


# --- Extraction -------------------------------------------------------------


def test_watermark_initial_incremental_and_empty(spark):
    df = fees(spark, range(1, 11))
    first = extract.watermark_delta(df, "id_comision", None, initial=True)
    assert (first.rows.count(), first.bound) == (10, 10)
    later = extract.watermark_delta(df, "id_comision", 7, initial=False)
    assert rows(later.rows, "id_comision") == [(10,), (8,), (9,)] and later.bound == 10
    assert extract.watermark_delta(df, "id_comision", None, initial=False).rows.count() == 10
    assert extract.watermark_delta(df.limit(0), "id_comision", None, initial=True).bound == 0


def test_watermark_is_pushed_to_the_files(spark):
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    rows_ = extract.watermark_delta(events, "event_id", 900, initial=False).rows
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(event_id,900)" in plan and "LessThanOrEqual(event_id,999)" in plan


def test_change_feed_takes_net_changes_within_the_bound(spark):
    df = fees(spark, range(1, 8))
    changes = spark.createDataFrame(
        [(1, 5, "I"), (1, 6, "U"), (2, 5, "U"), (2, 7, "D"), (3, 6, "U"), (3, 9, "U"), (4, 3, "U"), (5, 6, "D"), (5, 7, "I"), (99, 6, "I")],
        "id_comision bigint, version bigint, op string",
    )
    assert rows(extract.change_feed_delta(df, changes, "id_comision", last=4, bound=8), "id_comision") == [(1,), (5,)]
    # What lay beyond the bound comes with the next run.
    assert rows(extract.change_feed_delta(df, changes, "id_comision", last=8, bound=9), "id_comision") == [(3,)]


@pytest.mark.parametrize(
    ("table", "state", "exists", "code"),
    [
        (CLIENTES, None, True, "NO_ACTIVE_CONFIG"),
        (CLIENTES, extract.LoadState(CHANGE_TRACKING, is_active=False), True, "NO_ACTIVE_CONFIG"),
        (CLIENTES, extract.LoadState(CHANGE_TRACKING), False, "SOURCE_MISSING"),
        (CLIENTES, extract.LoadState(APPEND_WATERMARK), True, "APPEND_NOT_ENABLED"),
        (CLIENTES, extract.LoadState("OTHER"), True, "UNKNOWN_STRATEGY"),
        (COMISIONES, extract.LoadState(CHANGE_TRACKING, initial_load_completed=True), True, "FEED_EXPIRED"),
        (COMISIONES, extract.LoadState(CHANGE_TRACKING, initial_load_completed=True, last_change_version=2), True, "FEED_EXPIRED"),
    ],
)
def test_extracts_that_cannot_be_planned(spark, table, state, exists, code):
    df = fees(spark, [1])
    feed = extract.ChangeFeed(df, current_version=9, min_valid_version=3)
    with pytest.raises(extract.ExtractError) as error:
        extract.plan_extract(SPECS[table], state, lambda: df if exists else None, feed)
    assert error.value.code == code


def test_planned_extracts(spark):
    df = fees(spark, range(1, 6))
    feed = extract.ChangeFeed(spark.createDataFrame([(2, 7, "U")], "id_comision bigint, version bigint, op string"), 8, 3)
    full = extract.plan_extract(FEES, extract.LoadState(CHANGE_TRACKING), lambda: df, feed)
    assert (full.rows.count(), full.bound) == (5, 8)
    state = extract.LoadState(CHANGE_TRACKING, initial_load_completed=True, last_change_version=3)
    delta = extract.plan_extract(FEES, state, lambda: df, feed)
    assert rows(delta.rows, "id_comision") == [(2,)]
    movements = df.withColumnRenamed("id_comision", "id_mov")
    state = extract.LoadState(APPEND_WATERMARK, initial_load_completed=True, last_watermark_value=4)
    tail = extract.plan_extract(SPECS[MOVIMIENTOS], state, lambda: movements)
    assert (rows(tail.rows, "id_mov"), tail.bound) == ([(5,)], 5)


def test_jdbc_reads_are_parallel_only_over_a_numeric_key():
    options = extract.jdbc_options("jdbc:x", "dbo.T", column="id", bounds=(1, 900), partitions=16)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "16" and options["upperBound"] == "900"
    assert "partitionColumn" not in extract.jdbc_options("jdbc:x", "dbo.T")


# --- Landing ----------------------------------------------------------------


def test_landing_layout_rerun_and_empty_delta(spark, cfg, tmp_path):
    root = str(tmp_path / "b")
    day1 = RunContext("r1", datetime(2024, 1, 31, 23, 59), "b1")
    day2 = RunContext("r2", datetime(2024, 2, 1), "b2")
    path = bronze.land_bronze(fees(spark, [1, 2]), root, FEES, cfg, day1)
    assert f"{COMISIONES}/year=2024/month=01/day=31/run=r1/attempt=" in path
    bronze.land_bronze(fees(spark, []), root, FEES, cfg, day1)  # a repeated run adds and never replaces
    with pytest.raises(Exception, match="already exists"):
        bronze.land_bronze(fees(spark, [9]), root, FEES, cfg, day1, attempt=path.rpartition("=")[2])
    bronze.land_bronze(fees(spark, [3]), root, FEES, cfg, day2)
    bronze.land_bronze(fees(spark, []), root, FEES, cfg, RunContext("r3", datetime(2024, 2, 2)))
    landed = bronze.read_bronze(spark, root, FEES)
    assert rows(landed, "id_comision", "_batch_id") == [(1, "b1"), (2, "b1"), (3, "b2")]
    assert not set(bronze.PARTITIONS) & set(landed.columns)
    assert landed.select("_source_file", "_row_index").distinct().count() == 3
    assert landed.schema["_ingestion_timestamp_utc"].dataType.simpleString() == "timestamp"

    recent = bronze.read_bronze(spark, root, FEES, since=date(2024, 2, 1))
    assert rows(recent, "id_comision") == [(3,)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_stream_takes_each_file_once(spark, cfg, run, tmp_path):
    paths = [str(tmp_path / p) for p in ("in", "out", "progress")]
    for ids, total in (([1, 2], 2), ([3], 3), ([], 3)):
        if ids:
            fees(spark, ids).write.mode("append").parquet(paths[0])
        stream_bronze(spark, FEES, cfg, run, *paths).awaitTermination()
        got = spark.read.parquet(paths[1])
        assert got.count() == total
    assert {"_batch_id", "_source_system", "_ingestion_timestamp_utc"} <= set(got.columns)


# --- Control ----------------------------------------------------------------

LOG = "pipeline_run_id string, source_table string, batch_id string, seq bigint, status string, event_at_utc timestamp"
NOW = datetime(2024, 5, 1)


def config(spark):
    return spark.createDataFrame(
        [("dbo", "A", CHANGE_TRACKING, "id", None, 3, None, True, False, NOW), ("dbo", "B", APPEND_WATERMARK, None, "id", None, 7, False, True, NOW)],
        control.CONFIG_SCHEMA,
    )


def test_upsert_resets_strategy_and_keeps_progress(spark):
    incoming = spark.createDataFrame(
        [("dbo", "A", APPEND_WATERMARK, None, "k"), ("dbo", "C", CHANGE_TRACKING, "id", None)],
        "source_schema string, source_table string, load_strategy string, primary_key_column string, watermark_column string",
    )
    later = datetime(2024, 6, 1)
    got = {r["source_table"]: r for r in control.upsert_config(config(spark), incoming, later).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert (a["load_strategy"], a["primary_key_column"], a["watermark_column"], a["last_change_version"]) == (APPEND_WATERMARK, None, "k", 3)
    assert a["is_active"] and a["initial_load_completed"] and a["updated_at_utc"] == later
    assert b["last_watermark_value"] == 7 and b["updated_at_utc"] == NOW
    assert c["is_active"] and c["initial_load_completed"] is False and c["last_change_version"] is None


def test_start_only_once(spark):
    log = spark.createDataFrame([("r1", "A", "b", 1, "STARTED", NOW)], LOG)
    asked = spark.createDataFrame([("r1", "A", "b", 2, "", NOW), ("r1", "B", "b", 4, "", NOW), ("r1", "B", "b", 3, "", NOW)], LOG)
    assert rows(control.start_runs(log, asked), "pipeline_run_id", "source_table", "seq", "status") == [("r1", "B", 3, "STARTED")]


def test_completion_advances_what_the_strategy_names(spark):
    done = spark.createDataFrame([("A", 9, 1), ("B", 11, 1), ("B", 12, 2)], "source_table string, new_watermark bigint, seq bigint")
    got = {r["source_table"]: r for r in control.advance_progress(config(spark), done, NOW).collect()}
    assert (got["A"]["last_change_version"], got["A"]["initial_load_completed"]) == (3, True)  # inactive: untouched
    assert (got["B"]["last_watermark_value"], got["B"]["last_change_version"], got["B"]["initial_load_completed"]) == (12, None, True)


def test_completion_without_start_is_reported(spark):
    log = spark.createDataFrame([("r1", "A", "b", 1, "STARTED", NOW)], LOG)
    done = spark.createDataFrame([("r1", "A", "b", 2, "", NOW), ("r2", "A", "b", 3, "", NOW)], LOG)
    assert rows(control.without_start(log, done), "pipeline_run_id") == [("r2",)]


def test_failure_adds_event_and_error_then_state_is_failed(spark):
    failures = spark.createDataFrame(
        [("r1", "A", "b", 2, NOW, "copy", "E1", "boom", "trace")],
        "pipeline_run_id string, source_table string, batch_id string, seq bigint, event_at_utc timestamp, "
        "activity_name string, error_code string, error_message string, error_details string",
    )
    events, errors = control.fail_runs(failures)
    assert errors.first()["error_code"] == "E1" and errors.first()["occurred_at_utc"] == NOW
    log = spark.createDataFrame([("r1", "A", "b", 1, "STARTED", NOW)], LOG).unionByName(events, allowMissingColumns=True)
    state = control.latest_state(log).first()
    assert (state["status"], state["error_message"]) == ("FAILED", "boom")


def test_only_active_tables_are_listed_in_order(spark):
    listed = control.active_specs(config(spark).unionByName(config(spark).where("source_table = 'B'").replace("B", "0")))
    assert [r["source_table"] for r in listed.collect()] == ["0", "B"]


# --- Alerts -----------------------------------------------------------------


def test_alert_windows_batch_and_stream(spark, tmp_path):
    log = spark.createDataFrame([("FAILED", datetime(2024, 1, 1, 0, 7, 30)), ("STARTED", datetime(2024, 1, 1, 0, 7, 40))], "status string, event_at_utc timestamp")
    windows = failure_alerts(log)
    assert windows.count() == 5 and {r["failed_runs"] for r in windows.collect()} == {1}
    assert failure_alerts(log, threshold=1).isEmpty()

    path = str(tmp_path / "log")
    log.write.parquet(path)
    spark.createDataFrame([("FAILED", datetime(2024, 1, 2))], log.schema).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="lateness"):
        failure_alerts(spark.readStream.schema(log.schema).parquet(path))
    stream = failure_alerts(spark.readStream.schema(log.schema).parquet(path), lateness="10 minutes")
    query = stream.writeStream.format("memory").queryName("alerts").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("alerts").where("window_start < '2024-01-01 01:00:00'").count() == 5


# --- Sinks ------------------------------------------------------------------


def test_export_manifest_and_changed_file(spark, tmp_path):
    out = str(tmp_path / "x")
    frames = {COMISIONES: fees(spark, range(1, 8)).coalesce(1)}
    sinks.export_tables(frames, out, rows_per_file=5)
    recorded = sinks.manifest(spark, {COMISIONES: FEES.columns}, out)
    assert rows(recorded, "format", "rows") == [("csv", 2), ("csv", 5), ("parquet", 2), ("parquet", 5)]
    kept = spark.createDataFrame(recorded.collect(), recorded.schema)
    assert quality.check_hashes(sinks.manifest(spark, {COMISIONES: FEES.columns}, out), kept).isEmpty()
    folder = os.path.join(out, "csv", COMISIONES)
    name = next(f for f in sorted(os.listdir(folder)) if f.endswith(".csv"))
    with open(os.path.join(folder, name)) as file:
        assert file.readline().strip() == ",".join(FEES.columns)
    altered = kept.withColumn("sha256", F.when(F.col("path").endswith(name), "0").otherwise(F.col("sha256")))
    assert quality.check_hashes(recorded, altered).count() == 1
    assert quality.check_hashes(recorded, kept.where("format = 'csv'")).count() == 2
    with pytest.raises(ValueError):
        sinks.export_tables(frames, out, formats=["xml"])
    checked = quality.check_files(spark, out, {COMISIONES: 7, PRODUCTOS: 1})
    assert rows(checked, "tabla", "formato", "encontradas", "aprobado") == [
        (COMISIONES, "csv", 7, True), (COMISIONES, "parquet", 7, True), (PRODUCTOS, "csv", -1, False), (PRODUCTOS, "parquet", -1, False),
    ]


def test_load_order_clearing_and_count_check(spark):
    frames = {name: spark.range(n + 1) for n, name in enumerate(reversed(LOAD_ORDER))}
    calls, held = [], {}

    def write(name, df):
        calls.append(("write", name))
        held[name] = df.count()

    sinks.load_tables(frames, write, held.__getitem__, clear=lambda name: calls.append(("clear", name)))
    assert calls == [("clear", n) for n in reversed(LOAD_ORDER)] + [("write", n) for n in LOAD_ORDER]
    with pytest.raises(sinks.PublishError):
        sinks.load_tables(frames, write, lambda name: 0)


def test_normalize_types_and_nan(spark):
    df = spark.createDataFrame(
        [(1, 1, "P", "2024-01-05", float("nan"), None, "X")],
        "id_comision int, id_cli int, cod_prod string, fec_cobro string, vr_comision double, tip_comision string, estado_cobro string",
    )
    row = sinks.normalize(df, FEES).first()
    assert row["fec_cobro"] == date(2024, 1, 5) and row["vr_comision"] is None


def test_required_tables(spark):
    with pytest.raises(sinks.PublishError, match="absent_table"):
        sinks.require_tables(spark, "default", ["absent_table"])


# --- Source checks ----------------------------------------------------------


def test_columns_must_match_in_order(spark):
    df = fees(spark, [1])
    assert quality.check_columns(df, FEES.columns)
    assert not quality.check_columns(df.select(*reversed(df.columns)), FEES.columns)


def test_key_check_separates_nulls_from_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,), (2,)], "id_comision bigint")
    assert rows(quality.check_key(df, "t", "id_comision")) == [("t", "id_comision", 2, 2, False)]


def test_full_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None), (None, None), (None, None)], "k int, v string")
    assert quality.count_full_duplicates(df).first()[0] == 3
    assert quality.count_full_duplicates(df.limit(0)).first()[0] == 0


def test_consistency_is_not_strict_on_dates_here(spark):
    schema = "vr_aprobado int, vr_desembolsado int, sdo_capital int, fec_desembolso date, fec_venc date"
    same = date(2024, 1, 1)
    df = spark.createDataFrame([(3, 2, 1, same, same), (1, 2, 1, same, date(2023, 1, 1))], schema)
    assert rows(quality.check_consistency(df)) == [("fechas", 1, False), ("montos", 1, False)]


def test_report_names_failures(spark):
    checks = spark.createDataFrame([("b", False), ("a", False), ("c", True)], "control string, aprobado boolean")
    assert rows(quality.dq_report([checks])) == [(1, 2, "a|b", "FAILED")]
    assert rows(quality.dq_report([checks.where("aprobado")])) == [(1, 0, "", "PASSED")]


def test_both_formats_of_an_export_come_from_one_computation(spark, tmp_path):
    once = spark.range(200).repartition(3).select("id", F.current_timestamp().cast("string").alias("v"))
    sinks.export_tables({"t": once}, str(tmp_path), rows_per_file=50)
    csv = spark.read.option("header", True).csv(f"{tmp_path}/csv/t")
    assert rows(csv, "id", "v") == rows(spark.read.parquet(f"{tmp_path}/parquet/t").select(F.col("id").cast("string"), "v"))


def test_the_report_exports_once_and_keeps_every_check(spark, monkeypatch):
    """Both checks of files look at one export; each of the report's checks is in it."""
    exports, merged, export, report = [], [], sinks.export_tables, quality.dq_report
    monkeypatch.setattr(sinks, "export_tables", lambda frames, out, **kw: (exports.append(out), export(frames, out, **kw)))
    monkeypatch.setattr(quality, "dq_report", lambda checks: (merged.extend(checks), report(checks))[1])
    found = catalogue.all_queries()["dq_report"](spark, SMOKE).first()
    assert len(exports) == 1
    kinds = {r["control"].split(".")[0]: r["n"] for r in merged_counts(merged)}
    assert kinds == {"llave": 5, "referencia": 6, "nulos": 5, "anomalia": 3, "consistencia": 2, "dominio": 1, "archivo": 14, "huella": 12, "columnas": 6}
    assert found["controles_exitosos"] + found["controles_fallidos"] == sum(kinds.values())
    assert "archivo.tb_ausente.csv" in found["fallas"].split("|") and "huella.tb_productos_cat.csv" in found["fallas"].split("|")


def merged_counts(checks):
    every = checks[0]
    for df in checks[1:]:
        every = every.unionByName(df)
    return every.groupBy(F.split("control", r"\.")[0].alias("control")).agg(F.count("*").alias("n")).collect()
