"""Validation and reporting queries over published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tesora.config import UNKNOWN_CHANNEL
from tesora.functions.columns import ALERT_LEVELS
from tesora.operators.audit import duplicate_keys


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("cantidad")).select(F.lit(n).alias("tabla"), "cantidad") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("tabla")


def movement_profile(movements: DataFrame) -> DataFrame:
    return movements.agg(
        F.count("*").alias("total_movimientos_silver"),
        F.count_distinct("id_mov").alias("ids_movimiento_unicos"),
        F.count_if(~F.col("ind_fecha_rango_valido")).alias("fechas_fuera_rango"),
        F.count_if(~F.col("ind_canal_valido")).alias("canales_invalidos_detectados"),
        F.count_if(F.col("cod_canal") == UNKNOWN_CHANNEL).alias("canales_mapeados_desconocido"),
        F.count_if("ind_sospechoso").alias("movimientos_sospechosos"),
    )


def rule_listing(summary: DataFrame) -> DataFrame:
    return summary.orderBy("table_name", "quality_rule")


def top_suspicious(movements: DataFrame, n: int = 20) -> DataFrame:
    """The newest, then largest, suspicious movements; the id settles ties."""
    return (
        movements.where("ind_sospechoso")
        .select(
            "id_mov", "id_cli", "fec_mov", "vr_mov", "promedio_vr_mov_30d", "desv_vr_mov_30d", "cantidad_mov_30d",
            "ind_sospechoso",
        )
        .orderBy(F.desc("fec_mov"), F.desc("vr_mov"), F.asc("id_mov"))
        .limit(n)
    )


def kpi_view(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "total_clientes", "clientes_activos", "total_movimientos", "movimientos_sospechosos",
        "porcentaje_movimientos_sospechosos", "total_obligaciones", "obligaciones_en_mora",
        "porcentaje_obligaciones_en_mora", "saldo_total_cartera", "ingreso_total_comisiones", "fecha_corte",
    )


def alert_segments(mart: DataFrame) -> DataFrame:
    """Clients and their totals per alert level, most severe first."""
    segments = mart.groupBy("nivel_alerta_cliente").agg(
        F.count("*").alias("cantidad_clientes"),
        F.sum("cantidad_movimientos").alias("total_movimientos"),
        F.sum("movimientos_sospechosos").alias("movimientos_sospechosos"),
        F.sum("obligaciones_en_mora").alias("obligaciones_en_mora"),
        F.round(F.sum("saldo_total_capital"), 2).alias("saldo_total_cartera"),
        F.round(F.sum("valor_total_comisiones"), 2).alias("ingreso_total_comisiones"),
    )
    severity = F.array_position(F.array(*[F.lit(level) for level in ALERT_LEVELS]), F.col("nivel_alerta_cliente"))
    return segments.orderBy(F.when(severity > 0, severity).otherwise(len(ALERT_LEVELS) + 1))


def top_products(mart: DataFrame, n: int = 10) -> DataFrame:
    """Products by outstanding balance; the key settles ties."""
    return (
        mart.orderBy(F.desc("saldo_total_capital"), F.asc("producto_key"))
        .limit(n)
        .select(
            "producto_key", "desc_prod", "tip_prod", "clientes_con_movimientos", "cantidad_movimientos",
            "movimientos_sospechosos", "cantidad_obligaciones", "obligaciones_en_mora",
            F.round("saldo_total_capital", 2).alias("saldo_total_cartera"),
            F.round("valor_total_comisiones", 2).alias("ingreso_total_comisiones"),
        )
    )


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    return duplicate_keys(df, [key])


def out_of_period(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    return df.where((F.col(column) < F.lit(start)) | (F.col(column) > F.lit(end)))


def run_report(metrics: DataFrame) -> DataFrame:
    """Run metrics in reading order: by kind where there is one, then table."""
    return metrics.orderBy(*[c for c in ("table_type", "table_name") if c in metrics.columns])
