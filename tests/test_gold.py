from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import rows

from tesora.config import LakeConfig
from tesora.operators import audit, reports
from tesora.plans import gold

D = Decimal
MOV_FACT = "cliente_key int, producto_key string, id_mov bigint, vr_mov decimal(18,2), ind_sospechoso boolean, fecha_key int"
OBL_FACT = (
    "cliente_key int, producto_key string, id_oblig bigint, sdo_capital decimal(18,2), vr_aprobado decimal(18,2), "
    "vr_desembolsado decimal(18,2), ind_en_mora boolean, dias_mora_act int, fecha_desembolso_key int, fecha_venc_key int"
)
COM_FACT = "cliente_key int, producto_key string, id_comision bigint, vr_comision decimal(18,2), fecha_key int"


@pytest.fixture
def star(spark):
    make = spark.createDataFrame
    return {
        "dim_fecha": gold.date_dimension(make([(date(2024, 2, 28), date(2024, 3, 3))], "min_fecha date, max_fecha date")),
        "dim_cliente": make([(1, "ACTIVO"), (2, "INACTIVO"), (3, None)], "cliente_key int, estado_cli string"),
        "dim_producto": make([("P1", "uno"), ("P2", "dos")], "producto_key string, desc_prod string"),
        "fact_movimientos": make(
            [(1, "P1", 1, D("10.01"), True, 20240228), (1, "P2", 2, D("0.02"), False, 20240229), (1, "P1", 3, D("0.01"), False, 20240301)], MOV_FACT
        ),
        "fact_obligaciones": make(
            [(1, "P1", 1, D(5), D(9), D(8), True, 31, 20240228, 20240303), (2, "P1", 2, D(7), D(9), D(8), None, None, 20240301, 20240301)], OBL_FACT
        ),
        "fact_comisiones": make([(2, "P2", 1, D("-3.00"), 20240302)], COM_FACT),
    }


def test_date_dimension_over_a_leap_day(star):
    days = {r["fecha_key"]: r for r in star["dim_fecha"].collect()}
    assert list(sorted(days)) == [20240228, 20240229, 20240301, 20240302, 20240303]
    leap = days[20240229]
    assert (leap["nombre_mes"], leap["nombre_dia"], leap["dia_semana"], leap["trimestre"]) == ("FEBRERO", "JUEVES", 5, 1)
    assert days[20240302]["es_fin_semana"] and days[20240303]["es_fin_semana"] and not leap["es_fin_semana"]
    assert days[20240303]["dia_semana"] == 1 and days[20240303]["semana_anio"] == 9


def test_date_dimension_without_dates_is_empty(spark):
    bounds = spark.createDataFrame([(None, None)], "min_fecha date, max_fecha date")
    assert gold.date_dimension(bounds).isEmpty()
    with pytest.raises(audit.AuditError):
        audit.assert_not_empty(gold.date_dimension(bounds), "dim_fecha")


def test_bounds_take_nulls_and_periods_into_account(spark):
    make = spark.createDataFrame
    movements = make([(date(2020, 1, 1), False), (date(2024, 1, 5), True), (None, None)], "fec_mov date, ind_fecha_rango_valido boolean")
    obligations = make([(None, date(2024, 6, 1)), (date(2024, 1, 2), None)], "fec_desembolso date, fec_venc date")
    fees = make([(None,)], "fec_cobro date")
    assert tuple(gold.date_bounds(movements, obligations, fees).first()) == (date(2024, 1, 2), date(2024, 6, 1))
    dates = gold.business_dates(movements, obligations, fees)
    assert rows(dates) == [(date(2024, 1, 2),), (date(2024, 1, 5),), (date(2024, 6, 1),)]


def test_client_mart_fills_measures_only(star, run):
    mart = {r["cliente_key"]: r for r in gold.mart_table(star, "mart_cliente_360", LakeConfig(), run).collect()}
    one, two, three = mart[1], mart[2], mart[3]
    assert (one["cantidad_movimientos"], one["valor_total_movimientos"], one["valor_promedio_movimiento"]) == (3, D("10.04"), D("3.35"))
    assert (one["productos_con_movimiento"], one["ultima_fecha_movimiento_key"], one["porcentaje_movimientos_sospechosos"]) == (2, 20240301, 33.33)
    assert one["nivel_alerta_cliente"] == "MEDIO" and one["max_dias_mora"] == 31
    assert (two["obligaciones_en_mora"], two["max_dias_mora"], two["valor_total_comisiones"]) == (0, 0, D("-3.00"))
    assert three["cantidad_movimientos"] == 0 and three["ultima_fecha_movimiento_key"] is None and three["estado_cli"] is None
    assert three["porcentaje_movimientos_sospechosos"] == 0.0 and three["nivel_alerta_cliente"] == "BAJO"


def test_product_mart(star, run):
    mart = gold.mart_table(star, "mart_producto_rendimiento", LakeConfig(), run)
    assert rows(mart, "producto_key", "cantidad_movimientos", "clientes_con_movimientos", "saldo_total_capital", "cantidad_comisiones") == [
        ("P1", 2, 1, D("12.00"), 0), ("P2", 1, 1, D("0.00"), 1),
    ]


def test_kpi_is_one_row_even_without_facts(star, run):
    cfg = LakeConfig()
    row = gold.mart_table(star, "kpi_resumen_bancario", cfg, run).first()
    assert (row["total_clientes"], row["clientes_activos"], row["total_movimientos"], row["movimientos_sospechosos"]) == (3, 1, 3, 1)
    assert (row["porcentaje_movimientos_sospechosos"], row["porcentaje_obligaciones_en_mora"]) == (33.33, 50.0)
    assert (row["fecha_corte"], row["run_id"]) == (cfg.cutoff_date, "R1")
    empty = {**star, **{n: star[n].limit(0) for n in star if n.startswith("fact")}}
    kpi = gold.mart_table(empty, "kpi_resumen_bancario", cfg, run)
    row = kpi.first()
    assert kpi.count() == 1 and row["total_movimientos"] == 0 and row["porcentaje_movimientos_sospechosos"] is None


def test_kpi_needs_no_join(star, run):
    plan = gold.mart_table(star, "kpi_resumen_bancario", LakeConfig(), run)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_fact_obligations_without_arrears_days(spark):
    df = spark.createDataFrame(
        [(1, 1, "P", D(1), D(1), D(1), D(1), date(2024, 1, 1), date(2024, 1, 2), None, 1, "A", True, True, "h")],
        "id_oblig bigint, id_cli int, cod_prod string, vr_aprobado decimal(18,2), vr_desembolsado decimal(18,2), sdo_capital decimal(18,2), "
        "vr_cuota decimal(18,2), fec_desembolso date, fec_venc date, dias_mora_act int, num_cuotas_pend int, calif_riesgo string, "
        "ind_montos_consistentes boolean, ind_fechas_consistentes boolean, _record_hash string",
    )
    row = gold.fact_obligaciones(df).first()
    assert row["rango_mora"] == "MORA_MAYOR_90" and row["ind_en_mora"] is None and row["fecha_venc_key"] == 20240102


def test_orphans_count_null_and_unknown_keys(spark, star):
    assert all(r["inconsistencias"] == 0 for r in audit.orphan_counts(star).collect())
    audit.assert_no_orphans(audit.orphan_counts(star))
    bad = spark.createDataFrame([(None, "P1", 9, D(1), 20240302), (8, "P1", 10, D(1), 20250101), (8, "P1", 11, D(1), None)], COM_FACT)
    broken = {**star, "fact_comisiones": bad}
    found = {r["control"]: r["inconsistencias"] for r in audit.orphan_counts(broken).collect()}
    assert found["comisiones_sin_cliente"] == 3 and found["comisiones_sin_fecha"] == 2 and found["comisiones_sin_producto"] == 0
    with pytest.raises(audit.AuditError, match="comisiones_sin_cliente, comisiones_sin_fecha"):
        audit.assert_no_orphans(audit.orphan_counts(broken))
    assert rows(audit.orphans(bad, star["dim_cliente"], "cliente_key", "cliente_key")) == [(None, 1), (8, 2)]


def test_unique_keys_treat_null_as_a_key(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "k int")
    assert rows(audit.duplicate_keys(df, ["k"])) == [(None, 2)]
    with pytest.raises(audit.AuditError):
        audit.assert_unique(df, ["k"], "t")
    audit.assert_unique(df.distinct(), ["k"], "t")


def test_reconciliation_of_empty_and_different_sums(spark):
    none = spark.createDataFrame([], "v decimal(18,2)")
    some = spark.createDataFrame([(D("0.10"),), (D("0.20"),)], "v decimal(18,2)")
    audit.assert_reconciled(audit.reconcile_sums({"a": (none, "v"), "b": (some, "v")}, {"a": (none, "v"), "b": (some, "v")}))
    with pytest.raises(audit.AuditError, match="b"):
        audit.assert_reconciled(audit.reconcile_sums({"b": (some, "v")}, {"b": (some.limit(1), "v")}))


def test_alert_segments_order(spark):
    schema = ("nivel_alerta_cliente string, cantidad_movimientos bigint, movimientos_sospechosos bigint, obligaciones_en_mora bigint, "
              "saldo_total_capital decimal(18,2), valor_total_comisiones decimal(18,2)")  # fmt: skip
    df = spark.createDataFrame([(level, 1, 1, 1, D(1), D(1)) for level in ("OTRO", "BAJO", "ALTO", "MEDIO", "BAJO")], schema)
    got = [(r["nivel_alerta_cliente"], r["cantidad_clientes"]) for r in reports.alert_segments(df).collect()]
    assert got == [("ALTO", 1), ("MEDIO", 1), ("BAJO", 2), ("OTRO", 1)]


def test_idempotence_over_the_two_newest_runs(spark):
    data = [("a", "t", 5, 1), ("b", "t", 6, 2), ("c", "t", 6, 3), ("c", "u", 1, 3)]
    df = spark.createDataFrame(data, "run_id string, table_name string, row_count bigint, processed_at_utc int")
    assert rows(audit.idempotence(df)) == [("t", 6, 6, True), ("u", 1, None, None)]


def test_personal_columns_are_found_in_silver_not_in_gold(spark):
    exposed = spark.createDataFrame([("x", 1)], "NOMB_CLI string, id int")
    safe = spark.createDataFrame([("h",)], "num_cuenta_hash string")
    found = {r["capa"]: tuple(r)[1:] for r in audit.pii_scan({"silver": {"a": exposed}, "gold": {"b": safe, "c": safe}}).collect()}
    assert found == {"silver": (1, 0, 1, 1), "gold": (0, 2, 2, 0)}
