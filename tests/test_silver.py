from __future__ import annotations

import json
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import SMOKE, rows

from tesora.config import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SUCURSALES, SPECS
from tesora.operators import rules, skew
from tesora.plans import silver
from tesora.plans.catalogue import CFG, FACT_DATES, RUN, Lake, all_queries

D = Decimal
AT = datetime(2024, 3, 1)
TECHNICAL = "_ingestion_timestamp_utc timestamp, _source_file string, _row_index bigint, _batch_id string"


def frame(spark, table, data, at=AT):
    columns = SPECS[table].columns
    tail = [(at, "f1", i, "b1") for i in range(len(data))]
    full = [tuple(d.get(c) for c in columns) + t for d, t in zip(data, tail)]
    return spark.createDataFrame(full, f"{SPECS[table].ddl}, {TECHNICAL}")


def mov(ident, **over):
    base = {"id_mov": ident, "id_cli": 1, "cod_prod": " p1 ", "num_cuenta": "A", "fec_mov": date(2024, 2, 1), "vr_mov": D(10),
            "cod_canal": "app", "tip_mov": "x", "cod_estado_mov": "y"}
    return {**base, **over}


def obl(ident, **over):
    base = {"id_oblig": ident, "id_cli": 1, "cod_prod": "P1", "vr_aprobado": D(10), "vr_desembolsado": D(10), "sdo_capital": D(0),
            "fec_desembolso": date(2024, 1, 1), "fec_venc": date(2024, 1, 2), "dias_mora_act": 0}
    return {**base, **over}


def com(ident, **over):
    return {"id_comision": ident, "id_cli": 1, "cod_prod": "P1", "fec_cobro": date(2024, 1, 5), "vr_comision": D(1), **over}


@pytest.fixture
def bronze(spark):
    return {
        CLIENTES: frame(spark, CLIENTES, [{"id_cli": 1, "tip_doc": " cc "}, {"id_cli": None}]),
        PRODUCTOS: frame(spark, PRODUCTOS, [{"cod_prod": "p1"}]),
        SUCURSALES: frame(spark, SUCURSALES, [{"cod_suc": "s1"}]),
        MOVIMIENTOS: frame(
            spark,
            MOVIMIENTOS,
            [
                mov(1), mov(1), mov(2, fec_mov=None), mov(3, cod_canal=None), mov(4, fec_mov=date(2023, 12, 31), cod_canal="FAX"),
                mov(5, id_cli=None), mov(6, id_cli=9, cod_prod="P9"), mov(None), mov(7, fec_mov=date(2024, 1, 1)), mov(8, fec_mov=date(2024, 3, 31)),
                mov(9, fec_mov=date(2024, 4, 1)), mov(10, cod_prod=None),
            ],
        ),
        OBLIGACIONES: frame(
            spark,
            OBLIGACIONES,
            [obl(1), obl(2, sdo_capital=None), obl(3, sdo_capital=D(-1)), obl(4, fec_venc=date(2024, 1, 1)),
             obl(5, sdo_capital=None, fec_venc=date(2023, 1, 1)), obl(6, vr_desembolsado=D(11), fec_venc=date(2023, 1, 1))],
        ),
        COMISIONES: frame(spark, COMISIONES, [com(1), com(2, vr_comision=D(-1)), com(3, vr_comision=None), com(4, vr_comision=D(0))]),
    }


def quarantined(bronze, table, cfg, run):
    staged = silver.stage_table(bronze, table, cfg)
    return rules.to_quarantine(staged, table, cfg.specs[table].key, run)


def test_movement_rules(bronze, cfg, run):
    q = quarantined(bronze, MOVIMIENTOS, cfg, run)
    assert rows(q, "primary_key_value", "quality_rules") == sorted(
        [
            (None, "LLAVE_PRIMARIA_NULA"),
            ("1", "REGISTRO_DUPLICADO_DESCARTADO"),
            ("10", "PRODUCTO_INEXISTENTE"),
            ("4", "FECHA_MOVIMIENTO_FUERA_RANGO|CANAL_TRANSACCIONAL_INVALIDO"),
            ("5", "CLIENTE_INEXISTENTE"),
            ("6", "CLIENTE_INEXISTENTE|PRODUCTO_INEXISTENTE"),
            ("9", "FECHA_MOVIMIENTO_FUERA_RANGO"),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def test_movements_kept_flagged_and_mapped(bronze, cfg):
    built = silver.build_table(bronze, MOVIMIENTOS, cfg)
    found = {
        r["id_mov"]: (r["ind_fecha_rango_valido"], r["ind_canal_valido"], r["cod_canal"], r["cod_canal_original"], r["ind_sospechoso"], r["cantidad_mov_30d"])
        for r in built.collect()
    }
    assert set(found) == {1, 2, 3, 4, 7, 8, 9}
    assert found[2] == (None, True, "APP", "APP", False, None)
    assert found[3] == (True, None, "DESCONOCIDO", None, False, 0)
    assert found[4] == (False, False, "DESCONOCIDO", "FAX", False, None)
    assert found[7][0] is True and found[8][0] is True and found[9][0] is False


def test_obligation_rules_keep_rows(bronze, cfg, run):
    q = quarantined(bronze, OBLIGACIONES, cfg, run)
    assert rows(q, "primary_key_value", "quality_rules") == [
        ("3", "MONTOS_OBLIGACION_INCONSISTENTES"),
        ("4", "FECHAS_OBLIGACION_INCONSISTENTES"),
        ("5", "FECHAS_OBLIGACION_INCONSISTENTES"),
        ("6", "MONTOS_OBLIGACION_INCONSISTENTES|FECHAS_OBLIGACION_INCONSISTENTES"),
    ]
    built = silver.build_table(bronze, OBLIGACIONES, cfg)
    assert rows(built, "id_oblig", "ind_montos_consistentes", "ind_fechas_consistentes") == [
        (1, True, True), (2, None, True), (3, False, True), (4, True, False), (5, None, False), (6, False, False),
    ]


def test_negative_fee_is_audited_and_kept(bronze, cfg, run):
    assert rows(quarantined(bronze, COMISIONES, cfg, run), "primary_key_value", "quality_rules") == [("2", "VALOR_COMISION_NEGATIVO")]
    assert silver.build_table(bronze, COMISIONES, cfg).count() == 4


def test_quarantine_image_shows_the_stage_reached(bronze, cfg, run):
    q = quarantined(bronze, MOVIMIENTOS, cfg, run)
    assert tuple(q.columns) == rules.QUARANTINE_COLUMNS
    images = {r["primary_key_value"]: json.loads(r["record_json"]) for r in q.collect()}
    assert images["5"]["_product_exists"] is True and "_client_exists" not in images["5"]
    assert "ind_canal_valido" not in images["5"] and "id_cli" not in images["5"]
    assert images["4"]["ind_canal_valido"] is False and images["4"]["cod_canal"] == "FAX" and images["4"]["cod_canal_original"] == "FAX"
    assert "_client_exists" not in images["4"] and "_quality_rules" not in images["4"]
    assert not {"ind_canal_valido", "_client_exists"} & set(images["1"])
    one = q.where("primary_key_value = '4'").first()
    assert (one["run_id"], one["batch_id"], one["source_file"]) == ("R1", "b1", "f1")
    assert one["ingestion_timestamp_utc"] == AT and one["quarantined_at_utc"] == run.as_of


def test_missing_technical_columns_become_typed_nulls(bronze, cfg, run):
    plain = bronze[COMISIONES].select(*SPECS[COMISIONES].columns, rules.F.lit("X").alias("_quality_rules"))
    q = rules.to_quarantine(plain, COMISIONES, "id_comision", run)
    assert q.schema["ingestion_timestamp_utc"].dataType.simpleString() == "timestamp"
    assert q.first()["batch_id"] is None and q.first()["source_file"] is None


def test_null_keys_leave_and_text_is_standard(bronze, cfg):
    assert rows(silver.build_table(bronze, CLIENTES, cfg), "id_cli", "tip_doc") == [(1, "CC")]


@pytest.mark.parametrize("table", list(SPECS))
def test_staged_and_direct_builds_agree(spark, table):
    lake = Lake(spark, SMOKE)
    direct = lake.silver[table]
    staged = silver.silver_from_stage(lake.staged[table], table, CFG).select(*direct.columns)
    assert staged.exceptAll(direct).isEmpty() and direct.exceptAll(staged).isEmpty()


@pytest.mark.parametrize("table", [MOVIMIENTOS, OBLIGACIONES, COMISIONES])
def test_every_bronze_row_is_accounted_for(spark, table):
    """bronze = silver + rejected; flagged rows are in both silver and quarantine."""
    lake = Lake(spark, SMOKE)
    metrics = rules.stage_metrics({table: lake.staged[table]}, RUN).first()
    kept = lake.silver[table].count()
    q = rules.to_quarantine(lake.staged[table], table, CFG.specs[table].key, RUN)
    removed = q.where("quality_rules RLIKE 'DUPLICADO|INEXISTENTE|NULA'").count()
    assert metrics["bronze_rows"] == lake.bronze[table].count() == kept + removed
    assert metrics["silver_rows"] == kept and metrics["quarantined_rows"] == q.count()


def test_filters_and_columns_reach_the_scan(spark):
    lake = Lake(spark, SMOKE)
    plan = lake.silver[PRODUCTOS].select("cod_prod")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line or "Scan parquet" in line)
    assert "p_retailprice" not in scan


def test_outcomes_alone_shuffle_neither_rule_columns_nor_reference_checks(spark):
    """A reader of outcomes carries what the rules said; the reference checks add no shuffle at all."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = Lake(spark, SMOKE).staged[OBLIGACIONES]
        plan = staged.select("_quality_rules", "_accepted")._jdf.queryExecution().optimizedPlan().toString()
        held = staged.select("_quality_rules", "_accepted")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "sdo_capital" not in "".join(plan.split("Join LeftOuter")[:3])  # down to the copies' join
    # Obligations' own join, once for rows and once for keys, the copies, and the two joins that clients are read from.
    assert held.count("SortMergeJoin") == 5


@pytest.mark.parametrize("words", [2**18, 0])
def test_narrow_facts_have_the_rows_of_the_whole_ones(spark, bronze, cfg, words, monkeypatch):
    """Also where the newest copy has no client: it supersedes an older one that has."""
    monkeypatch.setattr(skew, "MAX_WORDS", words)
    older, newer = frame(spark, OBLIGACIONES, [obl(1), obl(2)]), frame(spark, OBLIGACIONES, [obl(1, id_cli=9), obl(3, cod_prod=None)], AT + timedelta(days=1))
    mine = {**bronze, OBLIGACIONES: older.unionByName(newer)}
    refs = silver.references(mine, cfg)
    assert refs.sent == (words > 0)
    assert rows(silver.narrow_fact(mine, OBLIGACIONES, ("fec_venc", "id_oblig"), cfg, refs), "id_oblig") == [(2,)]
    lake = Lake(spark, SMOKE)
    for table, columns in FACT_DATES.items():
        for names in (columns, ("id_cli", "cod_prod", *columns)):
            narrow, whole = silver.narrow_fact(lake.bronze, table, names, CFG, lake.refs), lake.silver[table].select(*names)
            assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()


def test_dates_alone_shuffle_no_references(spark):
    lake = Lake(spark, SMOKE)
    plan = silver.narrow_fact(lake.bronze, OBLIGACIONES, FACT_DATES[OBLIGACIONES], CFG, lake.refs)._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("WindowGroupLimit")[0] if "WindowGroupLimit" in plan else plan.split("Window [")[0] + plan.split("Window [")[1].split("\n")[1]
    assert "cod_prod" not in above and "id_cli" not in above and "_known" in above


@pytest.mark.parametrize("name", ["report_gold_counts", "report_gold_integrity"])
def test_gold_reports_rank_the_copies_of_a_fact_once(spark, name):
    """What is left to do when the report is planned reads written facts, and no source of theirs."""
    report = all_queries()[name](spark, SMOKE)
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "event_id" not in plan and "o_orderkey" not in plan
    assert report.count() == 10
