"""Dimensions, facts, marts and KPIs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesora.config import CLIENTES, COMISIONES, MOVIMIENTOS, OBLIGACIONES, PRODUCTOS, SUCURSALES, LakeConfig, RunContext
from tesora.functions.columns import (
    AGE_EDGES,
    AGE_LABELS,
    ARREARS_EDGES,
    ARREARS_LABELS,
    DAY_NAMES,
    MONTH_NAMES,
    SCORE_EDGES,
    SCORE_LABELS,
    SCORE_UNKNOWN,
    age_at,
    alert_level,
    bucket,
    date_key,
    label_at,
    percentage,
    pseudonym,
)
from tesora.plans.silver import IN_PERIOD

Frames = Mapping[str, DataFrame]

# --- Dimensions -------------------------------------------------------------


def business_dates(movements: DataFrame, obligations: DataFrame, fees: DataFrame) -> DataFrame:
    """Every date a fact refers to (not distinct; bounds are all that is asked of it)."""
    columns = [
        (movements.where(IN_PERIOD), "fec_mov"),
        (obligations, "fec_desembolso"),
        (obligations, "fec_venc"),
        (fees, "fec_cobro"),
    ]
    dates = [df.select(F.col(name).cast("date").alias("fecha")) for df, name in columns]
    return reduce(DataFrame.unionByName, dates).where(F.col("fecha").isNotNull())


def date_bounds(movements: DataFrame, obligations: DataFrame, fees: DataFrame) -> DataFrame:
    """One row (min_fecha, max_fecha); each fact is read and reduced once."""

    def bounds(df: DataFrame, *names: str) -> DataFrame:
        dates = [F.col(n).cast("date") for n in names]
        low, high = (dates[0], dates[0]) if len(dates) == 1 else (F.least(*dates), F.greatest(*dates))
        return df.agg(F.min(low).alias("min_fecha"), F.max(high).alias("max_fecha"))

    parts = [
        bounds(movements.where(IN_PERIOD), "fec_mov"),
        bounds(obligations, "fec_desembolso", "fec_venc"),
        bounds(fees, "fec_cobro"),
    ]
    return reduce(DataFrame.unionByName, parts).agg(
        F.min("min_fecha").alias("min_fecha"), F.max("max_fecha").alias("max_fecha")
    )


def date_dimension(bounds: DataFrame) -> DataFrame:
    """Each day within the bounds. Without dates there are no rows, which the
    non-empty check on publication reports."""
    days = bounds.where("min_fecha IS NOT NULL").select(
        F.explode(F.sequence("min_fecha", "max_fecha", F.expr("INTERVAL 1 DAY"))).alias("fecha")
    )
    weekday = F.dayofweek("fecha")
    return days.select(
        date_key("fecha").alias("fecha_key"),
        "fecha",
        F.year("fecha").alias("anio"),
        F.quarter("fecha").alias("trimestre"),
        F.month("fecha").alias("mes"),
        label_at(MONTH_NAMES, F.month("fecha")).alias("nombre_mes"),
        F.weekofyear("fecha").alias("semana_anio"),
        F.dayofmonth("fecha").alias("dia_mes"),
        weekday.alias("dia_semana"),
        label_at(DAY_NAMES, weekday).alias("nombre_dia"),
        weekday.isin(1, 7).alias("es_fin_semana"),
    )


def dim_fecha(silver: Frames) -> DataFrame:
    return date_dimension(date_bounds(silver[MOVIMIENTOS], silver[OBLIGACIONES], silver[COMISIONES]))


def dim_cliente(clients: DataFrame, cfg: LakeConfig) -> DataFrame:
    """Clients without names, documents or dates: ages and bands instead."""
    age = age_at("fec_nac", cfg.cutoff_date)
    return clients.select(
        F.col("id_cli").alias("cliente_key"),
        *("cod_segmento", "score_buro", "ciudad_res", "depto_res", "estado_cli", "canal_adquis", "_record_hash"),
        age.alias("edad_fecha_corte"),
        bucket(age, AGE_EDGES, AGE_LABELS).alias("rango_edad"),
        bucket("score_buro", SCORE_EDGES, SCORE_LABELS, null_label=SCORE_UNKNOWN).alias("rango_score_buro"),
        date_key("fec_alta").alias("fecha_alta_key"),
    )


# Fixed values in the dimensions below: their published columns.
def renamed(df: DataFrame, names: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in names.items()], *keep)


def dim_producto(products: DataFrame) -> DataFrame:
    keep = ("desc_prod", "tip_prod", "tasa_ea", "plazo_max_meses", "cuota_min", "comision_admin", "estado_prod")
    return renamed(products, {"cod_prod": "producto_key"}, (*keep, "_record_hash"))


def dim_sucursal(branches: DataFrame) -> DataFrame:
    keep = ("nom_suc", "tip_punto", "ciudad", "depto", "latitud", "longitud", "activo")
    return renamed(branches, {"cod_suc": "sucursal_key"}, (*keep, "_record_hash"))


# --- Facts ------------------------------------------------------------------

# The published columns of the facts, in their published order.
FACT_COLUMNS = {
    "fact_movimientos": (
        "id_mov", "cliente_key", "producto_key", "fecha_key", "hra_mov", "num_cuenta_hash", "vr_mov", "tip_mov", "cod_canal",
        "cod_ciudad", "cod_estado_mov", "ind_canal_valido", "ind_sospechoso", "promedio_vr_mov_30d", "desv_vr_mov_30d",
        "cantidad_mov_30d", "_record_hash",
    ),
    "fact_obligaciones": (
        "id_oblig", "cliente_key", "producto_key", "vr_aprobado", "vr_desembolsado", "sdo_capital", "vr_cuota",
        "fecha_desembolso_key", "fecha_venc_key", "dias_mora_act", "num_cuotas_pend", "calif_riesgo",
        "ind_montos_consistentes", "ind_fechas_consistentes", "_record_hash", "ind_en_mora", "rango_mora",
    ),
    "fact_comisiones": (
        "id_comision", "cliente_key", "producto_key", "fecha_key", "vr_comision", "tip_comision", "estado_cobro", "_record_hash",
    ),
}


def as_fact(name: str, df: DataFrame, added: Mapping[str, Column]) -> DataFrame:
    """The published columns of a fact; clients and products become keys of their dimensions."""
    keys = {"cliente_key": F.col("id_cli"), "producto_key": F.col("cod_prod")}
    return df.withColumns({**keys, **added}).select(*FACT_COLUMNS[name])


def fact_movimientos(movements: DataFrame) -> DataFrame:
    """Movements of the official period, the account pseudonymised."""
    added = {"fecha_key": date_key("fec_mov"), "num_cuenta_hash": pseudonym("num_cuenta")}
    return as_fact("fact_movimientos", movements.where(IN_PERIOD), added)


def fact_obligaciones(obligations: DataFrame) -> DataFrame:
    added = {
        "fecha_desembolso_key": date_key("fec_desembolso"),
        "fecha_venc_key": date_key("fec_venc"),
        "ind_en_mora": F.col("dias_mora_act") > 0,
        "rango_mora": bucket("dias_mora_act", ARREARS_EDGES, ARREARS_LABELS, inclusive=True),
    }
    return as_fact("fact_obligaciones", obligations, added)


def fact_comisiones(fees: DataFrame) -> DataFrame:
    return as_fact("fact_comisiones", fees, {"fecha_key": date_key("fec_cobro")})


# --- Measures ---------------------------------------------------------------


def money(name: str) -> Column:
    return F.round(F.sum(name), 2)


def hits(flag: str) -> Column:
    return F.sum(F.col(flag).cast("int"))


def measured(fact: DataFrame, key: str | None, measures: Mapping[str, Column]) -> DataFrame:
    columns = [column.alias(name) for name, column in measures.items()]
    return fact.groupBy(key).agg(*columns) if key else fact.agg(*columns)


def movements_by(fact: DataFrame, key: str = "cliente_key") -> DataFrame:
    measures = {
        "cantidad_movimientos": F.count("id_mov"),
        "valor_total_movimientos": money("vr_mov"),
        "movimientos_sospechosos": hits("ind_sospechoso"),
    }
    if key == "cliente_key":
        measures |= {
            "valor_promedio_movimiento": F.round(F.avg("vr_mov"), 2),
            "productos_con_movimiento": F.count_distinct("producto_key"),
            "ultima_fecha_movimiento_key": F.max("fecha_key"),
        }
    else:
        measures |= {"clientes_con_movimientos": F.count_distinct("cliente_key")}
    return measured(fact, key, measures)


def obligations_by(fact: DataFrame, key: str = "cliente_key") -> DataFrame:
    measures = {
        "cantidad_obligaciones": F.count("id_oblig"),
        "saldo_total_capital": money("sdo_capital"),
        "obligaciones_en_mora": hits("ind_en_mora"),
    }
    if key == "cliente_key":
        measures |= {"valor_total_aprobado": money("vr_aprobado"), "max_dias_mora": F.max("dias_mora_act")}
    else:
        measures |= {"valor_total_desembolsado": money("vr_desembolsado")}
    return measured(fact, key, measures)


def commissions_by(fact: DataFrame, key: str = "cliente_key") -> DataFrame:
    return measured(
        fact, key, {"cantidad_comisiones": F.count("id_comision"), "valor_total_comisiones": money("vr_comision")}
    )


# --- Marts ------------------------------------------------------------------


def extend_dimension(dim: DataFrame, key: str, parts: Sequence[DataFrame], stays_null: Sequence[str] = ()) -> DataFrame:
    """Left join per-key measures to a dimension; a key without facts measures 0.

    The parts arrive hash-partitioned by the key from their own aggregation, so
    the joins add no shuffle beyond the dimension's.
    """
    joined = reduce(lambda left, right: left.join(right, key, "left"), parts, dim)
    measures = [c for part in parts for c in part.columns if c != key and c not in stays_null]
    return joined.fillna(0, subset=measures)


def mart_cliente_360(dim: DataFrame, movements: DataFrame, obligations: DataFrame, fees: DataFrame) -> DataFrame:
    """One row per client from the client measures of the three facts."""
    mart = extend_dimension(
        dim, "cliente_key", [movements, obligations, fees], stays_null=["ultima_fecha_movimiento_key"]
    )
    return mart.withColumns(
        {
            "porcentaje_movimientos_sospechosos": percentage("movimientos_sospechosos", "cantidad_movimientos", 0.0),
            "nivel_alerta_cliente": alert_level("max_dias_mora", "movimientos_sospechosos"),
        }
    )


def mart_producto_rendimiento(
    dim: DataFrame, movements: DataFrame, obligations: DataFrame, fees: DataFrame
) -> DataFrame:
    return extend_dimension(dim, "producto_key", [movements, obligations, fees])


def kpi_parts(dim: DataFrame, movements: DataFrame, obligations: DataFrame, fees: DataFrame) -> list[DataFrame]:
    """Four one-row results, one per source."""
    return [
        measured(dim, None, {
            "total_clientes": F.count("cliente_key"),
            "clientes_activos": F.sum((F.col("estado_cli") == "ACTIVO").cast("int")),
        }),
        measured(movements, None, {
            "total_movimientos": F.count("id_mov"),
            "valor_total_movimientos": money("vr_mov"),
            "movimientos_sospechosos": hits("ind_sospechoso"),
        }),
        measured(obligations, None, {
            "total_obligaciones": F.count("id_oblig"),
            "saldo_total_cartera": money("sdo_capital"),
            "obligaciones_en_mora": hits("ind_en_mora"),
        }),
        measured(fees, None, {
            "total_comisiones": F.count("id_comision"),
            "ingreso_total_comisiones": money("vr_comision"),
        }),
    ]


def kpi_resumen(parts: Sequence[DataFrame], cfg: LakeConfig, run: RunContext) -> DataFrame:
    """The parts side by side in one row.

    Each part fills its own columns, so stacking them and taking the only
    value of each column aligns them without joining.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    return row.withColumns(
        {
            "porcentaje_movimientos_sospechosos": percentage("movimientos_sospechosos", "total_movimientos"),
            "porcentaje_obligaciones_en_mora": percentage("obligaciones_en_mora", "total_obligaciones"),
            "fecha_corte": F.lit(cfg.cutoff_date),
            "run_id": F.lit(run.run_id),
        }
    )


# --- The whole layer --------------------------------------------------------

KINDS = {
    "dim_fecha": "DIMENSION", "dim_cliente": "DIMENSION", "dim_producto": "DIMENSION", "dim_sucursal": "DIMENSION",
    "fact_movimientos": "FACT", "fact_obligaciones": "FACT", "fact_comisiones": "FACT",
    "mart_cliente_360": "MART", "mart_producto_rendimiento": "MART", "kpi_resumen_bancario": "MART",
}

KEYS = {
    "dim_fecha": "fecha_key", "dim_cliente": "cliente_key", "dim_producto": "producto_key",
    "dim_sucursal": "sucursal_key", "fact_movimientos": "id_mov", "fact_obligaciones": "id_oblig",
    "fact_comisiones": "id_comision", "mart_cliente_360": "cliente_key",
    "mart_producto_rendimiento": "producto_key", "kpi_resumen_bancario": "run_id",
}


def star_table(silver: Frames, name: str, cfg: LakeConfig) -> DataFrame:
    """One dimension or fact from the silver tables it needs."""
    builders = {
        "dim_fecha": lambda: dim_fecha(silver),
        "dim_cliente": lambda: dim_cliente(silver[CLIENTES], cfg),
        "dim_producto": lambda: dim_producto(silver[PRODUCTOS]),
        "dim_sucursal": lambda: dim_sucursal(silver[SUCURSALES]),
        "fact_movimientos": lambda: fact_movimientos(silver[MOVIMIENTOS]),
        "fact_obligaciones": lambda: fact_obligaciones(silver[OBLIGACIONES]),
        "fact_comisiones": lambda: fact_comisiones(silver[COMISIONES]),
    }
    return builders[name]()


def mart_table(star: Frames, name: str, cfg: LakeConfig, run: RunContext) -> DataFrame:
    """One mart from the star."""
    facts = [star[fact] for fact in ("fact_movimientos", "fact_obligaciones", "fact_comisiones")]
    if name == "kpi_resumen_bancario":
        return kpi_resumen(kpi_parts(star["dim_cliente"], *facts), cfg, run)
    dim, build = {
        "mart_cliente_360": ("dim_cliente", mart_cliente_360),
        "mart_producto_rendimiento": ("dim_producto", mart_producto_rendimiento),
    }[name]
    measures = (movements_by, obligations_by, commissions_by)
    return build(star[dim], *[measure(fact, KEYS[dim]) for measure, fact in zip(measures, facts)])


STAR = tuple(name for name, kind in KINDS.items() if kind != "MART")
MARTS = tuple(name for name, kind in KINDS.items() if kind == "MART")


def build_star(silver: Frames, cfg: LakeConfig) -> dict[str, DataFrame]:
    """The four dimensions and three facts."""
    return {name: star_table(silver, name, cfg) for name in STAR}


def build_marts(star: Frames, cfg: LakeConfig, run: RunContext) -> dict[str, DataFrame]:
    return {name: mart_table(star, name, cfg, run) for name in MARTS}
