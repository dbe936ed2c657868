"""What each registered query must return, as SQL over the given tables.

Written against the raw tables and the meaning of each query, in plain window
and join formulations rather than the engine's own plans. ``CTES`` are building
blocks in dependency order; a query carries only the ones it mentions.
"""

from __future__ import annotations

import re

from tesora.sources.bindings import CONTROL_SQL, SOURCE_SQL

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
PLAIN = {t: t for t in TABLES}

START, END, CUTOFF = "DATE '2024-01-03'", "DATE '2024-01-28'", "DATE '2024-01-31'"
CHANNELS = "('CLICK', 'VIEW', 'PURCHASE', 'SIGNUP')"


def out(source: str, columns: str, tail: str = "") -> str:
    """SELECT columns from a source; ``name:d`` is read as DOUBLE, ``name:b`` as BIGINT, ``name:s`` as text."""
    kinds = {"d": "DOUBLE", "b": "BIGINT", "s": "VARCHAR"}
    items = []
    for token in columns.split():
        name, _, kind = token.partition(":")
        items.append(f"CAST({name} AS {kinds[kind]}) AS {name}" if kind else name)
    return f"SELECT {', '.join(items)} FROM {source} {tail}".strip()


def hashed(columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<NULL>')" for c in sorted(columns.split()))
    return f"sha256(concat_ws('||', {parts}))"


def mean(total: str, n: str, scale: int) -> str:
    """total / n for decimals with two places, exact: half up to 6 places, then to ``scale``."""
    six = f"((2 * CAST({total} * 100 AS HUGEINT) * 10000 + {n}) // (2 * {n}))"
    return six if scale == 6 else f"CAST((({six} + 5000) // 10000) * 0.01 AS DECIMAL(19, 2))"


CLI = "id_cli nomb_cli apell_cli tip_doc num_doc fec_nac fec_alta cod_segmento score_buro ciudad_res depto_res estado_cli canal_adquis"
PRO = "cod_prod desc_prod tip_prod tasa_ea plazo_max_meses cuota_min comision_admin estado_prod"
SUC = "cod_suc nom_suc tip_punto ciudad depto latitud longitud activo"
MOV = "id_mov id_cli cod_prod num_cuenta fec_mov hra_mov vr_mov tip_mov cod_canal cod_ciudad cod_estado_mov id_dispositivo"
OBL = "id_oblig id_cli cod_prod vr_aprobado vr_desembolsado sdo_capital vr_cuota fec_desembolso fec_venc dias_mora_act num_cuotas_pend calif_riesgo"
COM = "id_comision id_cli cod_prod fec_cobro vr_comision tip_comision estado_cobro"
MOV_SILVER = MOV + " cod_canal_original ind_fecha_rango_valido ind_canal_valido promedio_vr_mov_30d desv_vr_mov_30d cantidad_mov_30d ind_sospechoso"
OBL_SILVER = OBL + " ind_montos_consistentes ind_fechas_consistentes"

TYPED = {
    "id_cli": "b", "score_buro": "d", "tasa_ea": "d", "plazo_max_meses": "b", "cuota_min": "d", "comision_admin": "d",
    "latitud": "d", "longitud": "d", "id_mov": "b", "vr_mov": "d", "id_oblig": "b", "vr_aprobado": "d",
    "vr_desembolsado": "d", "sdo_capital": "d", "vr_cuota": "d", "dias_mora_act": "b", "num_cuotas_pend": "b",
    "id_comision": "b", "vr_comision": "d", "promedio_vr_mov_30d": "d", "desv_vr_mov_30d": "d", "cantidad_mov_30d": "d",
    "cliente_key": "b", "edad_fecha_corte": "b", "fecha_alta_key": "b", "fecha_key": "b", "fecha_desembolso_key": "b",
    "fecha_venc_key": "b",
    "fec_nac": "s", "fec_alta": "s", "fec_mov": "s", "fec_desembolso": "s", "fec_venc": "s", "fec_cobro": "s",
    "fecha_corte": "s",
    "cantidad_movimientos": "b", "valor_total_movimientos": "d", "valor_promedio_movimiento": "d",
    "movimientos_sospechosos": "b", "productos_con_movimiento": "b", "ultima_fecha_movimiento_key": "d",
    "cantidad_obligaciones": "b", "valor_total_aprobado": "d", "saldo_total_capital": "d", "obligaciones_en_mora": "b",
    "max_dias_mora": "b", "cantidad_comisiones": "b", "valor_total_comisiones": "d", "clientes_con_movimientos": "b",
    "valor_total_desembolsado": "d", "porcentaje_movimientos_sospechosos": "d", "porcentaje_obligaciones_en_mora": "d",
    "total_clientes": "b", "clientes_activos": "b", "total_movimientos": "b", "total_obligaciones": "b",
    "saldo_total_cartera": "d", "total_comisiones": "b", "ingreso_total_comisiones": "d",
    "rows_read": "b", "rows_copied": "b", "bytes_written": "b", "duration_seconds": "b", "seq": "b",
    "last_change_version": "d", "last_watermark_value": "d", "row_count": "b",
    "bronze_rows": "b", "silver_rows": "b", "quarantined_rows": "b",
}


def typed(source: str, columns: str, tail: str = "") -> str:
    return out(source, " ".join(f"{c}:{TYPED[c]}" if c in TYPED else c for c in columns.split()), tail)


def standard(source: str, text: str, upper: str) -> str:
    changed = [f"upper(trim({c})) AS {c}" for c in upper.split()]
    changed += [f"trim({c}) AS {c}" for c in text.split() if c not in upper.split()]
    return f"SELECT * REPLACE ({', '.join(changed)}) FROM {source}"


def newest(source: str, key: str, order: str) -> str:
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rk FROM {source} WHERE {key} IS NOT NULL"
    )


def referenced(source: str) -> str:
    return f"""SELECT f.*, concat_ws('|', CASE WHEN c.id_cli IS NULL THEN 'CLIENTE_INEXISTENTE' END,
    CASE WHEN p.cod_prod IS NULL THEN 'PRODUCTO_INEXISTENTE' END) AS reglas
  FROM {source} f LEFT JOIN std_cli c ON f.id_cli = c.id_cli LEFT JOIN std_pro p ON f.cod_prod = p.cod_prod
  WHERE f.rk = 1"""


def key_of(column: str) -> str:
    return f"CAST(strftime({column}, '%Y%m%d') AS INTEGER)"


CTES: dict[str, str] = {
    "src_cli": SOURCE_SQL["tb_clientes_core"].format(**PLAIN),
    "src_pro": SOURCE_SQL["tb_productos_cat"].format(**PLAIN),
    "src_suc": SOURCE_SQL["tb_sucursales_red"].format(**PLAIN),
    "one_mov": SOURCE_SQL["tb_mov_financieros"].format(**PLAIN),
    "src_mov": "SELECT *, 1 AS lote FROM one_mov UNION ALL SELECT *, 2 AS lote FROM one_mov WHERE id_mov % 300 = 0",
    "src_obl": SOURCE_SQL["tb_obligaciones"].format(**PLAIN),
    "src_com": SOURCE_SQL["tb_comisiones_log"].format(**PLAIN),
    **{f"c_{name}": sql.format(**PLAIN) for name, sql in CONTROL_SQL.items()},
    # Standard text
    "std_cli": standard(
        "src_cli", "nomb_cli apell_cli tip_doc num_doc cod_segmento ciudad_res depto_res estado_cli canal_adquis",
        "tip_doc cod_segmento estado_cli canal_adquis",
    ),
    "std_pro": standard("src_pro", "cod_prod desc_prod tip_prod estado_prod", "cod_prod tip_prod estado_prod"),
    "std_suc": standard("src_suc", "cod_suc nom_suc tip_punto ciudad depto", "cod_suc tip_punto"),
    "std_mov": standard(
        "src_mov",
        "cod_prod num_cuenta hra_mov tip_mov cod_canal cod_ciudad cod_estado_mov id_dispositivo",
        "cod_prod tip_mov cod_canal cod_estado_mov",
    ),
    "std_obl": standard("src_obl", "cod_prod calif_riesgo", "cod_prod calif_riesgo"),
    "std_com": standard("src_com", "cod_prod tip_comision estado_cobro", "cod_prod tip_comision estado_cobro"),
    # Copies ranked, references checked
    "rk_mov": newest("std_mov", "id_mov", "lote DESC"),
    "rk_obl": newest("std_obl", "id_oblig", "_ord1 DESC, _ord2 DESC, _ord3 DESC, _ord4 DESC"),
    "rk_com": newest("std_com", "id_comision", "fec_cobro DESC"),
    "ref_mov": referenced("rk_mov"),
    "ref_obl": referenced("rk_obl"),
    "ref_com": referenced("rk_com"),
    # Silver
    "sil_cli": f"SELECT *, {hashed(CLI)} AS _record_hash FROM std_cli",
    "sil_pro": f"SELECT *, {hashed(PRO)} AS _record_hash FROM std_pro",
    "sil_suc": f"SELECT *, {hashed(SUC)} AS _record_hash FROM std_suc",
    "flag_obl": """SELECT *, vr_aprobado >= vr_desembolsado AND vr_desembolsado >= sdo_capital AND sdo_capital >= 0 AS ind_montos_consistentes,
    fec_venc > fec_desembolso AS ind_fechas_consistentes FROM ref_obl WHERE reglas = ''""",
    "sil_obl": f"SELECT *, {hashed(OBL_SILVER)} AS _record_hash FROM flag_obl",
    "sil_com": f"SELECT *, {hashed(COM)} AS _record_hash FROM ref_com WHERE reglas = ''",
    "flag_mov": f"""SELECT * REPLACE (CASE WHEN cod_canal IN {CHANNELS} THEN cod_canal ELSE 'DESCONOCIDO' END AS cod_canal),
    cod_canal AS cod_canal_original, fec_mov BETWEEN {START} AND {END} AS ind_fecha_rango_valido,
    cod_canal IN {CHANNELS} AS ind_canal_valido FROM ref_mov WHERE reglas = ''""",
    "stat_mov": """SELECT id_mov, count(vr_mov) OVER w AS n, sum(vr_mov) OVER w AS s, stddev_samp(CAST(vr_mov AS DOUBLE)) OVER w AS sd
    FROM flag_mov WHERE ind_fecha_rango_valido WINDOW w AS (PARTITION BY id_cli ORDER BY fec_mov
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)""",
    "mark_mov": f"""SELECT m.*, CASE WHEN n > 0 THEN {mean('s', 'n', 2)} END AS promedio_vr_mov_30d,
    CAST(round(CAST(sd AS DECIMAL(28, 8)), 2) AS DOUBLE) AS desv_vr_mov_30d, n AS cantidad_mov_30d,
    coalesce(n >= 2 AND CAST(vr_mov AS DOUBLE) > {mean('s', 'n', 6)} / 1e6 + 3 * coalesce(sd, 0), false) AS ind_sospechoso
    FROM flag_mov m LEFT JOIN stat_mov t ON m.id_mov = t.id_mov""",
    "sil_mov": f"SELECT *, {hashed(MOV_SILVER)} AS _record_hash FROM mark_mov",
    # Quarantine
    "rejected": f"""
    SELECT 'tb_mov_financieros' AS table_name, CAST(id_mov AS VARCHAR) AS primary_key_value, 'REGISTRO_DUPLICADO_DESCARTADO' AS quality_rules, lote FROM rk_mov WHERE rk > 1
    UNION ALL SELECT 'tb_mov_financieros', CAST(id_mov AS VARCHAR), reglas, lote FROM ref_mov WHERE reglas <> ''
    UNION ALL SELECT 'tb_mov_financieros', CAST(id_mov AS VARCHAR), concat_ws('|', CASE WHEN NOT ind_fecha_rango_valido THEN 'FECHA_MOVIMIENTO_FUERA_RANGO' END,
      CASE WHEN NOT ind_canal_valido THEN 'CANAL_TRANSACCIONAL_INVALIDO' END), lote FROM flag_mov WHERE NOT ind_fecha_rango_valido OR NOT ind_canal_valido
    UNION ALL SELECT 'tb_obligaciones', CAST(id_oblig AS VARCHAR), 'REGISTRO_DUPLICADO_DESCARTADO', 1 FROM rk_obl WHERE rk > 1
    UNION ALL SELECT 'tb_obligaciones', CAST(id_oblig AS VARCHAR), reglas, 1 FROM ref_obl WHERE reglas <> ''
    UNION ALL SELECT 'tb_obligaciones', CAST(id_oblig AS VARCHAR), concat_ws('|', CASE WHEN NOT ind_montos_consistentes THEN 'MONTOS_OBLIGACION_INCONSISTENTES' END,
      CASE WHEN NOT ind_fechas_consistentes THEN 'FECHAS_OBLIGACION_INCONSISTENTES' END), 1 FROM flag_obl WHERE NOT ind_montos_consistentes OR NOT ind_fechas_consistentes
    UNION ALL SELECT 'tb_comisiones_log', CAST(id_comision AS VARCHAR), reglas, 1 FROM ref_com WHERE reglas <> ''
    UNION ALL SELECT 'tb_comisiones_log', CAST(id_comision AS VARCHAR), 'VALOR_COMISION_NEGATIVO', 1 FROM sil_com WHERE vr_comision < 0""",
    # Star
    "g_bounds": """SELECT min(d) AS min_fecha, max(d) AS max_fecha FROM (
    SELECT fec_mov AS d FROM sil_mov WHERE ind_fecha_rango_valido UNION ALL SELECT fec_desembolso FROM sil_obl
    UNION ALL SELECT fec_venc FROM sil_obl UNION ALL SELECT fec_cobro FROM sil_com) dates""",
    "g_dias": "SELECT CAST(unnest(generate_series(min_fecha, max_fecha, INTERVAL 1 DAY)) AS DATE) AS fecha FROM g_bounds",
    "g_fecha": f"""SELECT {key_of('fecha')} AS fecha_key, fecha, year(fecha) AS anio, quarter(fecha) AS trimestre, month(fecha) AS mes,
    ['ENERO', 'FEBRERO', 'MARZO', 'ABRIL', 'MAYO', 'JUNIO', 'JULIO', 'AGOSTO', 'SEPTIEMBRE', 'OCTUBRE', 'NOVIEMBRE', 'DICIEMBRE'][month(fecha)] AS nombre_mes,
    week(fecha) AS semana_anio, day(fecha) AS dia_mes, dayofweek(fecha) + 1 AS dia_semana,
    ['DOMINGO', 'LUNES', 'MARTES', 'MIERCOLES', 'JUEVES', 'VIERNES', 'SABADO'][dayofweek(fecha) + 1] AS nombre_dia,
    dayofweek(fecha) IN (0, 6) AS es_fin_semana FROM g_dias""",
    "g_edad": f"SELECT *, date_sub('year', fec_nac, {CUTOFF}) AS edad_fecha_corte FROM sil_cli",
    "g_cliente": f"""SELECT id_cli AS cliente_key, cod_segmento, score_buro, ciudad_res, depto_res, estado_cli, canal_adquis, _record_hash, edad_fecha_corte,
    CASE WHEN edad_fecha_corte < 25 THEN '18-24' WHEN edad_fecha_corte < 35 THEN '25-34' WHEN edad_fecha_corte < 45 THEN '35-44'
      WHEN edad_fecha_corte < 55 THEN '45-54' WHEN edad_fecha_corte < 65 THEN '55-64' ELSE '65+' END AS rango_edad,
    CASE WHEN score_buro IS NULL THEN 'SIN_INFORMACION' WHEN score_buro < 500 THEN 'MUY_BAJO' WHEN score_buro < 650 THEN 'BAJO'
      WHEN score_buro < 750 THEN 'MEDIO' ELSE 'ALTO' END AS rango_score_buro, {key_of('fec_alta')} AS fecha_alta_key FROM g_edad""",
    "g_producto": "SELECT cod_prod AS producto_key, desc_prod, tip_prod, tasa_ea, plazo_max_meses, cuota_min, comision_admin, estado_prod, _record_hash FROM sil_pro",
    "g_sucursal": "SELECT cod_suc AS sucursal_key, nom_suc, tip_punto, ciudad, depto, latitud, longitud, activo, _record_hash FROM sil_suc",
    "f_mov": f"""SELECT id_cli AS cliente_key, cod_prod AS producto_key, id_mov, {key_of('fec_mov')} AS fecha_key, hra_mov, sha256(num_cuenta) AS num_cuenta_hash,
    vr_mov, tip_mov, cod_canal, cod_ciudad, cod_estado_mov, ind_canal_valido, ind_sospechoso, promedio_vr_mov_30d, desv_vr_mov_30d, cantidad_mov_30d, _record_hash
    FROM sil_mov WHERE ind_fecha_rango_valido""",
    "f_obl": f"""SELECT id_cli AS cliente_key, cod_prod AS producto_key, id_oblig, vr_aprobado, vr_desembolsado, sdo_capital, vr_cuota,
    {key_of('fec_desembolso')} AS fecha_desembolso_key, {key_of('fec_venc')} AS fecha_venc_key, dias_mora_act, num_cuotas_pend, calif_riesgo,
    ind_montos_consistentes, ind_fechas_consistentes, dias_mora_act > 0 AS ind_en_mora,
    CASE WHEN dias_mora_act <= 0 THEN 'AL_DIA' WHEN dias_mora_act <= 30 THEN 'MORA_1_30' WHEN dias_mora_act <= 60 THEN 'MORA_31_60'
      WHEN dias_mora_act <= 90 THEN 'MORA_61_90' ELSE 'MORA_MAYOR_90' END AS rango_mora, _record_hash FROM sil_obl""",
    "f_com": f"""SELECT id_cli AS cliente_key, cod_prod AS producto_key, id_comision, {key_of('fec_cobro')} AS fecha_key, vr_comision, tip_comision, estado_cobro, _record_hash FROM sil_com""",
    # Measures
    "a_mov_cli": f"""SELECT cliente_key, count(id_mov) AS cantidad_movimientos, sum(vr_mov) AS valor_total_movimientos,
    count(*) FILTER (ind_sospechoso) AS movimientos_sospechosos, {mean('sum(vr_mov)', 'count(vr_mov)', 2)} AS valor_promedio_movimiento,
    count(DISTINCT producto_key) AS productos_con_movimiento, max(fecha_key) AS ultima_fecha_movimiento_key FROM f_mov GROUP BY cliente_key""",
    "a_obl_cli": """SELECT cliente_key, count(id_oblig) AS cantidad_obligaciones, sum(sdo_capital) AS saldo_total_capital,
    count(*) FILTER (ind_en_mora) AS obligaciones_en_mora, sum(vr_aprobado) AS valor_total_aprobado, max(dias_mora_act) AS max_dias_mora FROM f_obl GROUP BY cliente_key""",
    "a_com_cli": "SELECT cliente_key, count(id_comision) AS cantidad_comisiones, sum(vr_comision) AS valor_total_comisiones FROM f_com GROUP BY cliente_key",
    "a_mov_pro": """SELECT producto_key, count(id_mov) AS cantidad_movimientos, sum(vr_mov) AS valor_total_movimientos,
    count(*) FILTER (ind_sospechoso) AS movimientos_sospechosos, count(DISTINCT cliente_key) AS clientes_con_movimientos FROM f_mov GROUP BY producto_key""",
    "a_obl_pro": """SELECT producto_key, count(id_oblig) AS cantidad_obligaciones, sum(sdo_capital) AS saldo_total_capital,
    count(*) FILTER (ind_en_mora) AS obligaciones_en_mora, sum(vr_desembolsado) AS valor_total_desembolsado FROM f_obl GROUP BY producto_key""",
    "a_com_pro": "SELECT producto_key, count(id_comision) AS cantidad_comisiones, sum(vr_comision) AS valor_total_comisiones FROM f_com GROUP BY producto_key",
    # Marts
    "m_zero_cli": """SELECT d.*, coalesce(cantidad_movimientos, 0) AS cantidad_movimientos, coalesce(valor_total_movimientos, 0) AS valor_total_movimientos,
    coalesce(valor_promedio_movimiento, 0) AS valor_promedio_movimiento, coalesce(movimientos_sospechosos, 0) AS movimientos_sospechosos,
    coalesce(productos_con_movimiento, 0) AS productos_con_movimiento, ultima_fecha_movimiento_key,
    coalesce(cantidad_obligaciones, 0) AS cantidad_obligaciones, coalesce(valor_total_aprobado, 0) AS valor_total_aprobado,
    coalesce(saldo_total_capital, 0) AS saldo_total_capital, coalesce(obligaciones_en_mora, 0) AS obligaciones_en_mora,
    coalesce(max_dias_mora, 0) AS max_dias_mora, coalesce(cantidad_comisiones, 0) AS cantidad_comisiones,
    coalesce(valor_total_comisiones, 0) AS valor_total_comisiones
    FROM g_cliente d LEFT JOIN a_mov_cli a ON d.cliente_key = a.cliente_key LEFT JOIN a_obl_cli o ON d.cliente_key = o.cliente_key
    LEFT JOIN a_com_cli c ON d.cliente_key = c.cliente_key""",
    "m_cli": """SELECT *, CASE WHEN cantidad_movimientos > 0 THEN round(100 * movimientos_sospechosos / cantidad_movimientos, 2) ELSE 0.0 END AS porcentaje_movimientos_sospechosos,
    CASE WHEN max_dias_mora > 90 OR movimientos_sospechosos >= 10 THEN 'ALTO' WHEN max_dias_mora > 30 OR movimientos_sospechosos > 0 THEN 'MEDIO' ELSE 'BAJO' END AS nivel_alerta_cliente
    FROM m_zero_cli""",
    "m_pro": """SELECT d.*, coalesce(cantidad_movimientos, 0) AS cantidad_movimientos, coalesce(valor_total_movimientos, 0) AS valor_total_movimientos,
    coalesce(movimientos_sospechosos, 0) AS movimientos_sospechosos, coalesce(clientes_con_movimientos, 0) AS clientes_con_movimientos,
    coalesce(cantidad_obligaciones, 0) AS cantidad_obligaciones, coalesce(saldo_total_capital, 0) AS saldo_total_capital,
    coalesce(obligaciones_en_mora, 0) AS obligaciones_en_mora, coalesce(valor_total_desembolsado, 0) AS valor_total_desembolsado,
    coalesce(cantidad_comisiones, 0) AS cantidad_comisiones, coalesce(valor_total_comisiones, 0) AS valor_total_comisiones
    FROM g_producto d LEFT JOIN a_mov_pro a ON d.producto_key = a.producto_key LEFT JOIN a_obl_pro o ON d.producto_key = o.producto_key
    LEFT JOIN a_com_pro c ON d.producto_key = c.producto_key""",
    "m_kpi": f"""SELECT *, round(100 * movimientos_sospechosos / total_movimientos, 2) AS porcentaje_movimientos_sospechosos,
    round(100 * obligaciones_en_mora / total_obligaciones, 2) AS porcentaje_obligaciones_en_mora, {CUTOFF} AS fecha_corte, 'RUN-0001' AS run_id
    FROM (SELECT
    (SELECT count(*) FROM g_cliente) AS total_clientes, (SELECT count(*) FROM g_cliente WHERE estado_cli = 'ACTIVO') AS clientes_activos,
    (SELECT count(*) FROM f_mov) AS total_movimientos, (SELECT sum(vr_mov) FROM f_mov) AS valor_total_movimientos,
    (SELECT count(*) FROM f_mov WHERE ind_sospechoso) AS movimientos_sospechosos,
    (SELECT count(*) FROM f_obl) AS total_obligaciones, (SELECT sum(sdo_capital) FROM f_obl) AS saldo_total_cartera,
    (SELECT count(*) FROM f_obl WHERE ind_en_mora) AS obligaciones_en_mora,
    (SELECT count(*) FROM f_com) AS total_comisiones, (SELECT sum(vr_comision) FROM f_com) AS ingreso_total_comisiones) totals""",
    # Source checks as (control, aprobado)
    "k_llave": "\n    UNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{key}' AS llave, count(*) FILTER ({key} IS NULL) AS nulos, count({key}) - count(DISTINCT {key}) AS duplicados FROM {src}"
        for table, key, src in (
            ("tb_clientes_core", "id_cli", "src_cli"), ("tb_productos_cat", "cod_prod", "src_pro"),
            ("tb_obligaciones", "id_oblig", "src_obl"), ("tb_sucursales_red", "cod_suc", "src_suc"),
            ("tb_comisiones_log", "id_comision", "src_com"),
        )
    ),
    "k_ref": "\n    UNION ALL ".join(
        f"SELECT '{table}.{fk}' AS control, count(*) AS referencias_invalidas FROM {src} f WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{fk} = f.{fk})"
        for table, src in (("tb_mov_financieros", "src_mov"), ("tb_obligaciones", "src_obl"), ("tb_comisiones_log", "src_com"))
        for fk, dim in (("id_cli", "src_cli"), ("cod_prod", "src_pro"))
    ),
    "k_nulos": "\n    UNION ALL ".join(
        f"SELECT '{table}' AS tabla, '{c}' AS columna, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS tasa FROM {src}"
        for table, src, columns in (
            ("tb_clientes_core", "src_cli", ("score_buro", "canal_adquis")), ("tb_mov_financieros", "src_mov", ("id_dispositivo",)),
            ("tb_obligaciones", "src_obl", ("calif_riesgo",)), ("tb_comisiones_log", "src_com", ("tip_comision",)),
        )
        for c in columns
    ),
    "copias": f"SELECT count(*) - count(DISTINCT ({', '.join(MOV.split())})) AS filas_duplicadas FROM src_mov",
    "k_anomalia": f"""SELECT 'duplicate_transactions' AS anomalia, filas_duplicadas AS detectadas, 3 AS previstas FROM copias
    UNION ALL SELECT 'out_of_range_dates', count(*), 20 FROM src_mov WHERE fec_mov < {START} OR fec_mov > {END}
    UNION ALL SELECT 'inconsistent_transaction_fields', count(*), 30 FROM src_mov WHERE upper(trim(cod_canal)) NOT IN {CHANNELS}""",
    "k_consistencia": """SELECT 'montos' AS control, count(*) AS incumplimientos FROM src_obl
      WHERE NOT coalesce(vr_aprobado >= vr_desembolsado AND vr_desembolsado >= sdo_capital AND sdo_capital >= 0, false)
    UNION ALL SELECT 'fechas', count(*) FROM src_obl WHERE NOT coalesce(fec_venc >= fec_desembolso, false)""",
    "k_dominio": "SELECT tip_prod AS valor, count(*) AS filas, coalesce(tip_prod IN ('ECONOMY', 'STANDARD', 'PROMO', 'MEDIUM'), false) AS permitido FROM src_pro GROUP BY tip_prod",
    "controles": """SELECT concat('llave.', tabla) AS control, nulos = 0 AND duplicados = 0 AS aprobado FROM k_llave
    UNION ALL SELECT concat('referencia.', control), referencias_invalidas = 0 FROM k_ref
    UNION ALL SELECT concat('nulos.', tabla, '.', columna), abs(tasa - 0.05) <= 0.01 FROM k_nulos
    UNION ALL SELECT concat('anomalia.', anomalia), detectadas >= previstas FROM k_anomalia
    UNION ALL SELECT concat('consistencia.', control), incumplimientos = 0 FROM k_consistencia
    UNION ALL SELECT 'dominio.tip_prod', coalesce(bool_and(permitido), true) FROM k_dominio
    UNION ALL SELECT concat('archivo.', t, '.', f), t <> 'tb_ausente'
      FROM (SELECT unnest(['tb_clientes_core', 'tb_productos_cat', 'tb_sucursales_red', 'tb_mov_financieros', 'tb_obligaciones', 'tb_comisiones_log', 'tb_ausente']) AS t)
      JOIN (SELECT unnest(['csv', 'parquet']) AS f) ON true
    UNION ALL SELECT concat('huella.', t, '.', f), NOT (t = 'tb_productos_cat' AND f = 'csv')
      FROM (SELECT unnest(['tb_clientes_core', 'tb_productos_cat', 'tb_sucursales_red', 'tb_mov_financieros', 'tb_obligaciones', 'tb_comisiones_log']) AS t)
      JOIN (SELECT unnest(['csv', 'parquet']) AS f) ON true
    UNION ALL SELECT concat('columnas.', t), true
      FROM (SELECT unnest(['tb_clientes_core', 'tb_productos_cat', 'tb_sucursales_red', 'tb_mov_financieros', 'tb_obligaciones', 'tb_comisiones_log']) AS t)""",
}


def mentioned(sql: str) -> set[str]:
    return {name for name in CTES if re.search(rf"\b{name}\b", sql)}


def compose(sql: str) -> str:
    """Prefix a query with the building blocks it needs, directly or not."""
    needed, frontier = set(), mentioned(sql)
    while frontier:
        needed |= frontier
        frontier = set().union(*(mentioned(CTES[name]) for name in frontier)) - needed
    blocks = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    return f"WITH {', '.join(blocks)}\n{sql}" if blocks else sql


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS tabla, count(*) AS cantidad FROM {source}" for name, source in tables.items())


def orphan_list(relations: dict[str, tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS control, count(*) AS inconsistencias FROM {fact} f LEFT JOIN {dim} d ON f.{fk} = d.{pk} WHERE d.{pk} IS NULL"
        for name, (fact, fk, dim, pk) in relations.items()
    )


def star_relations(mov: str, obl: str, com: str) -> dict[str, tuple[str, str, str, str]]:
    return {
        "movimientos_sin_cliente": (mov, "cliente_key", "g_cliente", "cliente_key"),
        "movimientos_sin_producto": (mov, "producto_key", "g_producto", "producto_key"),
        "movimientos_sin_fecha": (mov, "fecha_key", "g_fecha", "fecha_key"),
        "obligaciones_sin_cliente": (obl, "cliente_key", "g_cliente", "cliente_key"),
        "obligaciones_sin_producto": (obl, "producto_key", "g_producto", "producto_key"),
        "obligaciones_sin_fecha_desembolso": (obl, "fecha_desembolso_key", "g_fecha", "fecha_key"),
        "obligaciones_sin_fecha_vencimiento": (obl, "fecha_venc_key", "g_fecha", "fecha_key"),
        "comisiones_sin_cliente": (com, "cliente_key", "g_cliente", "cliente_key"),
        "comisiones_sin_producto": (com, "producto_key", "g_producto", "producto_key"),
        "comisiones_sin_fecha": (com, "fecha_key", "g_fecha", "fecha_key"),
    }


SOURCES = {
    "tb_clientes_core": "src_cli", "tb_productos_cat": "src_pro", "tb_sucursales_red": "src_suc",
    "tb_mov_financieros": "src_mov", "tb_obligaciones": "src_obl", "tb_comisiones_log": "src_com",
}
SILVERS = {name: source.replace("src_", "sil_") for name, source in SOURCES.items()}
GOLDS = {
    "dim_cliente": "g_cliente", "dim_fecha": "g_fecha", "dim_producto": "g_producto", "dim_sucursal": "g_sucursal",
    "fact_comisiones": "f_com", "fact_movimientos": "f_mov", "fact_obligaciones": "f_obl",
    "kpi_resumen_bancario": "m_kpi", "mart_cliente_360": "m_cli", "mart_producto_rendimiento": "m_pro",
}
KIND = {"dim": "DIMENSION", "fact": "FACT", "mart": "MART", "kpi": "MART"}
LOG_KEYS = "pipeline_run_id source_table batch_id seq"
CONFIG_OUT = "source_schema source_table load_strategy primary_key_column watermark_column last_change_version last_watermark_value initial_load_completed"

DIM_CLI = "cliente_key cod_segmento score_buro ciudad_res depto_res estado_cli canal_adquis _record_hash edad_fecha_corte rango_edad rango_score_buro fecha_alta_key"
DIM_PRO = "producto_key desc_prod tip_prod tasa_ea plazo_max_meses cuota_min comision_admin estado_prod _record_hash"
MOV_CLI = "cantidad_movimientos valor_total_movimientos movimientos_sospechosos valor_promedio_movimiento productos_con_movimiento ultima_fecha_movimiento_key"
OBL_CLI = "cantidad_obligaciones saldo_total_capital obligaciones_en_mora valor_total_aprobado max_dias_mora"
COM_ANY = "cantidad_comisiones valor_total_comisiones"
MOV_PRO = "cantidad_movimientos valor_total_movimientos movimientos_sospechosos clientes_con_movimientos"
OBL_PRO = "cantidad_obligaciones saldo_total_capital obligaciones_en_mora valor_total_desembolsado"
KPI = "total_clientes clientes_activos total_movimientos valor_total_movimientos movimientos_sospechosos total_obligaciones saldo_total_cartera obligaciones_en_mora total_comisiones ingreso_total_comisiones porcentaje_movimientos_sospechosos porcentaje_obligaciones_en_mora fecha_corte"
SUMS = {
    "valor_total_movimientos": ("sil_mov WHERE ind_fecha_rango_valido", "f_mov", "vr_mov"),
    "saldo_total_cartera": ("sil_obl", "f_obl", "sdo_capital"),
    "ingreso_total_comisiones": ("sil_com", "f_com", "vr_comision"),
}
COUNTED = {
    "fact_movimientos": "sil_mov WHERE ind_fecha_rango_valido", "fact_obligaciones": "sil_obl", "fact_comisiones": "sil_com",
    "dim_cliente": "sil_cli", "dim_producto": "sil_pro", "dim_sucursal": "sil_suc",
}
SEGMENTS = """SELECT nivel_alerta_cliente, count(*) AS cantidad_clientes, CAST(sum(cantidad_movimientos) AS BIGINT) AS total_movimientos,
  CAST(sum(movimientos_sospechosos) AS BIGINT) AS movimientos_sospechosos, CAST(sum(obligaciones_en_mora) AS BIGINT) AS obligaciones_en_mora,
  CAST(sum(saldo_total_capital) AS DOUBLE) AS saldo_total_cartera, CAST(sum(valor_total_comisiones) AS DOUBLE) AS ingreso_total_comisiones
  FROM m_cli GROUP BY nivel_alerta_cliente"""
METRICS_TWO = """SELECT run_id, row_number() OVER (ORDER BY max(processed_at_utc) DESC, run_id DESC) AS orden FROM c_run_metrics GROUP BY run_id"""
MANIFEST = {
    "tb_clientes_core": ("src_cli", CLI), "tb_productos_cat": ("src_pro", PRO), "tb_sucursales_red": ("src_suc", SUC),
    "tb_mov_financieros": ("src_mov", MOV), "tb_obligaciones": ("src_obl", OBL), "tb_comisiones_log": ("src_com", COM),
}

BODIES: dict[str, str] = {
    "bronze_watermark_delta": typed("src_mov", MOV, "WHERE id_mov > 5000 AND id_mov <= (SELECT max(id_mov) FROM src_mov)"),
    "bronze_change_delta": typed(
        "src_cli s", CLI,
        """WHERE EXISTS (SELECT 1 FROM (SELECT id_cli, op, version, row_number() OVER (PARTITION BY id_cli ORDER BY version DESC) AS rk
        FROM c_client_changes WHERE version > 4) n WHERE n.rk = 1 AND n.version <= 8 AND n.op IN ('I', 'U') AND n.id_cli = s.id_cli)""",
    ),
    "bronze_land_roundtrip": typed("src_mov", MOV),
    "ingest_retry": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS filas, 'SUCCEEDED' AS estado, CAST({3 if name == 'tb_productos_cat' else 2} AS BIGINT) AS eventos FROM {source}"
        for name, source in SOURCES.items()
    ),
    "bronze_read": "SELECT CAST(lote AS VARCHAR) AS lote, CAST(CAST(DATE '2024-02-01' + (lote - 1) AS DATE) AS VARCHAR) AS dia, count(*) AS filas, count(*) AS posiciones FROM src_mov GROUP BY lote",
    "bronze_stream_available_now": typed("src_mov", MOV),
    "export_manifest": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, fmt AS format, '{columns.replace(' ', ',')}' AS columns, count(*) AS filas, NOT ('{name}' = 'tb_productos_cat' AND fmt = 'csv') AS huellas_validas FROM {source} JOIN (SELECT unnest(['csv', 'parquet']) AS fmt) formats ON true GROUP BY fmt"
        for name, (source, columns) in MANIFEST.items()
    ),
    "dq_check_files": " UNION ALL ".join(
        [
            f"SELECT '{name}' AS tabla, '{fmt}' AS formato, count(*) AS esperadas, count(*) AS encontradas, true AS aprobado FROM {source}"
            for name, source in SOURCES.items()
            for fmt in ("csv", "parquet")
        ]
        + [f"SELECT 'tb_ausente', '{fmt}', CAST(1 AS BIGINT), CAST(-1 AS BIGINT), false" for fmt in ("csv", "parquet")]
    ),
    "load_reconcile": counts(SOURCES),
    "publish_silver": counts(SILVERS),
    "publish_gold": " UNION ALL ".join(
        f"SELECT '{KIND[name.split('_')[0]]}' AS table_type, '{name}' AS table_name, count(*) AS row_count FROM {source}"
        for name, source in GOLDS.items()
    ),
    "ctl_active_config": typed("c_config", CONFIG_OUT, "WHERE is_active"),
    "ctl_config_upsert": """SELECT coalesce(t.source_schema, s.source_schema) AS source_schema, coalesce(t.source_table, s.source_table) AS source_table,
      CASE WHEN s.source_table IS NULL THEN t.load_strategy ELSE s.load_strategy END AS load_strategy,
      CASE WHEN s.source_table IS NULL THEN t.primary_key_column ELSE s.primary_key_column END AS primary_key_column,
      CASE WHEN s.source_table IS NULL THEN t.watermark_column ELSE s.watermark_column END AS watermark_column,
      CAST(last_change_version AS DOUBLE) AS last_change_version, CAST(last_watermark_value AS DOUBLE) AS last_watermark_value,
      coalesce(initial_load_completed, false) AS initial_load_completed, s.source_table IS NOT NULL OR is_active AS is_active
      FROM c_config t FULL OUTER JOIN c_config_changes s ON t.source_schema = s.source_schema AND t.source_table = s.source_table""",
    "ctl_run_start": f"""SELECT {LOG_KEYS.replace(' ', ', ')}, status, event_at_utc FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_run_id, source_table ORDER BY event_at_utc, seq) AS rk
      FROM c_run_log WHERE status = 'STARTED') r WHERE rk = 1 AND NOT EXISTS (SELECT 1 FROM c_run_log k WHERE k.status = 'SKIPPED' AND k.pipeline_run_id = r.pipeline_run_id AND k.source_table = r.source_table)""",
    "ctl_run_complete": typed(
        "c_run_log r", LOG_KEYS + " status event_at_utc rows_read rows_copied bytes_written duration_seconds output_path",
        "WHERE status = 'SUCCEEDED' AND EXISTS (SELECT 1 FROM c_run_log k WHERE k.status = 'STARTED' AND k.pipeline_run_id = r.pipeline_run_id AND k.source_table = r.source_table)",
    ).replace(" FROM c_run_log r", ", CAST(NULL AS VARCHAR) AS error_message FROM c_run_log r", 1),
    "ctl_run_progress": """SELECT source_schema, source_table, load_strategy, primary_key_column, watermark_column,
      CAST(CASE WHEN is_active AND mark IS NOT NULL AND load_strategy = 'CHANGE_TRACKING' THEN mark ELSE last_change_version END AS DOUBLE) AS last_change_version,
      CAST(CASE WHEN is_active AND mark IS NOT NULL AND load_strategy = 'APPEND_WATERMARK' THEN mark ELSE last_watermark_value END AS DOUBLE) AS last_watermark_value,
      initial_load_completed OR (is_active AND mark IS NOT NULL) AS initial_load_completed, is_active
      FROM c_config c LEFT JOIN (SELECT source_table AS t, new_watermark AS mark FROM (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rk
      FROM c_run_log WHERE status = 'SUCCEEDED') x WHERE rk = 1) m ON c.source_table = m.t""",
    "ctl_run_fail": typed("c_run_log", LOG_KEYS + " status event_at_utc error_message", "WHERE status = 'FAILED'"),
    "ctl_run_errors": """SELECT pipeline_run_id, source_table, batch_id, activity_name, error_code, error_message, error_details, event_at_utc AS occurred_at_utc FROM c_run_log WHERE status = 'FAILED'""",
    "ctl_latest_state": typed(
        "(SELECT *, row_number() OVER (PARTITION BY pipeline_run_id, source_table ORDER BY seq DESC) AS rk FROM c_run_log) l",
        LOG_KEYS + " status event_at_utc rows_read rows_copied", "WHERE rk = 1",
    ),
    "ctl_failure_alerts": """SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, count(*) AS failed_runs FROM (
      SELECT date_trunc('minute', event_at_utc) - to_minutes(back) AS window_start FROM c_run_log JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS back) b ON true
      WHERE status = 'FAILED') w GROUP BY window_start""",
    "clean_standardize": typed("std_cli", CLI),
    "clean_null_keys": "SELECT CAST(id_mov AS BIGINT) AS id_mov, id_dispositivo, CASE WHEN id_dispositivo IS NULL THEN 'LLAVE_PRIMARIA_NULA' ELSE 'CON_LLAVE' END AS lado FROM src_mov",
    "dedupe_latest": typed("(" + newest("src_obl", "id_oblig", "_ord1 DESC, _ord2 DESC, _ord3 DESC, _ord4 DESC") + ") d", OBL, "WHERE rk = 1"),
    "dedupe_discarded": typed("(" + newest("src_obl", "id_oblig", "_ord1 DESC, _ord2 DESC, _ord3 DESC, _ord4 DESC") + ") d", OBL, "WHERE rk > 1"),
    "ref_invalid": typed("ref_obl", "id_oblig id_cli cod_prod reglas", "WHERE reglas <> ''"),
    "ref_valid": typed("ref_com", COM, "WHERE reglas = ''"),
    "oblig_flags": """SELECT id_oblig, ind_montos_consistentes, ind_fechas_consistentes, concat_ws('|', CASE WHEN NOT ind_montos_consistentes THEN 'MONTOS_OBLIGACION_INCONSISTENTES' END,
      CASE WHEN NOT ind_fechas_consistentes THEN 'FECHAS_OBLIGACION_INCONSISTENTES' END) AS reglas FROM flag_obl""",
    "commission_negative": "SELECT id_comision, CAST(vr_comision AS DOUBLE) AS vr_comision, 'VALOR_COMISION_NEGATIVO' AS reglas FROM ref_com WHERE reglas = '' AND vr_comision < 0",
    "mov_flags": typed("flag_mov", "id_mov cod_canal cod_canal_original ind_fecha_rango_valido ind_canal_valido"),
    "quarantine_all": """SELECT 'RUN-0001' AS run_id, table_name, primary_key_value, quality_rules, CAST(lote AS VARCHAR) AS batch_id,
      concat(table_name, '/batch-', CAST(lote AS VARCHAR), '.parquet') AS source_file FROM rejected""",
    "quality_rule_summary": "SELECT table_name, quality_rule, count(*) AS rejected_rows FROM (SELECT table_name, unnest(string_split(quality_rules, '|')) AS quality_rule FROM rejected) r GROUP BY table_name, quality_rule",
    "silver_run_metrics": " UNION ALL ".join(
        f"SELECT 'RUN-0001' AS run_id, '{name}' AS table_name, (SELECT count(*) FROM {SOURCES[name]}) AS bronze_rows, (SELECT count(*) FROM {SILVERS[name]}) AS silver_rows, (SELECT count(*) FROM rejected WHERE table_name = '{name}') AS quarantined_rows"
        for name in SOURCES
    ),
    "guard_channels": "SELECT cod_canal AS valor, count(*) AS filas, cod_canal IN ('CLICK', 'VIEW', 'PURCHASE', 'SIGNUP', 'DESCONOCIDO') AS permitido FROM flag_mov GROUP BY cod_canal",
    "record_hash": out("sil_pro", "cod_prod _record_hash"),
    "rolling_stats_30d": typed("mark_mov", "id_mov promedio_vr_mov_30d desv_vr_mov_30d cantidad_mov_30d"),
    "suspicious_movements": typed("mark_mov", "id_mov id_cli fec_mov vr_mov promedio_vr_mov_30d desv_vr_mov_30d cantidad_mov_30d", "WHERE ind_sospechoso"),
    "silver_clientes": typed("sil_cli", CLI + " _record_hash"),
    "silver_productos": typed("sil_pro", PRO + " _record_hash"),
    "silver_sucursales": typed("sil_suc", SUC + " _record_hash"),
    "silver_obligaciones": typed("sil_obl", OBL_SILVER + " _record_hash"),
    "silver_comisiones": typed("sil_com", COM + " _record_hash"),
    "silver_movimientos": typed("sil_mov", MOV_SILVER + " _record_hash"),
    "date_bounds": out("g_bounds", "min_fecha:s max_fecha:s"),
    "dim_fecha": out("g_fecha", "fecha_key:b fecha:s anio:b trimestre:b mes:b nombre_mes semana_anio:b dia_mes:b dia_semana:b nombre_dia es_fin_semana"),
    "dim_cliente": typed("g_cliente", DIM_CLI),
    "dim_producto": typed("g_producto", DIM_PRO),
    "dim_sucursal": typed("g_sucursal", "sucursal_key nom_suc tip_punto ciudad depto latitud longitud activo _record_hash"),
    "fact_movimientos": typed("f_mov", "cliente_key producto_key id_mov fecha_key hra_mov num_cuenta_hash vr_mov tip_mov cod_canal cod_ciudad cod_estado_mov ind_canal_valido ind_sospechoso promedio_vr_mov_30d desv_vr_mov_30d cantidad_mov_30d _record_hash"),
    "fact_obligaciones": typed("f_obl", "cliente_key producto_key id_oblig vr_aprobado vr_desembolsado sdo_capital vr_cuota fecha_desembolso_key fecha_venc_key dias_mora_act num_cuotas_pend calif_riesgo ind_montos_consistentes ind_fechas_consistentes ind_en_mora rango_mora _record_hash"),
    "fact_comisiones": typed("f_com", "cliente_key producto_key id_comision fecha_key vr_comision tip_comision estado_cobro _record_hash"),
    "agg_mov_cliente": typed("a_mov_cli", "cliente_key " + MOV_CLI),
    "agg_oblig_cliente": typed("a_obl_cli", "cliente_key " + OBL_CLI),
    "agg_com_cliente": typed("a_com_cli", "cliente_key " + COM_ANY),
    "agg_mov_producto": typed("a_mov_pro", "producto_key " + MOV_PRO),
    "agg_oblig_producto": typed("a_obl_pro", "producto_key " + OBL_PRO),
    "agg_com_producto": typed("a_com_pro", "producto_key " + COM_ANY),
    "mart_cliente_360": typed("m_cli", f"{DIM_CLI} {MOV_CLI} {OBL_CLI} {COM_ANY} porcentaje_movimientos_sospechosos nivel_alerta_cliente"),
    "mart_producto_rendimiento": typed("m_pro", f"{DIM_PRO} {MOV_PRO} {OBL_PRO} {COM_ANY}"),
    "kpi_resumen": typed("m_kpi", KPI + " run_id"),
    "audit_duplicate_keys": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS claves_duplicadas, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS filas_excedentes FROM (SELECT count(*) AS n FROM {source} GROUP BY {key} HAVING count(*) > 1) d"
        for (name, source), key in zip(SOURCES.items(), ("id_cli", "cod_prod", "cod_suc", "id_mov", "id_oblig", "id_comision"))
    ),
    "audit_orphans": orphan_list(
        star_relations(
            f"(SELECT id_cli AS cliente_key, cod_prod AS producto_key, {key_of('fec_mov')} AS fecha_key FROM rk_mov WHERE rk = 1)",
            f"(SELECT id_cli AS cliente_key, cod_prod AS producto_key, {key_of('fec_desembolso')} AS fecha_desembolso_key, {key_of('fec_venc')} AS fecha_venc_key FROM rk_obl WHERE rk = 1)",
            f"(SELECT id_cli AS cliente_key, cod_prod AS producto_key, {key_of('fec_cobro')} AS fecha_key FROM rk_com WHERE rk = 1)",
        )
    ),
    "audit_reconcile_counts": " UNION ALL ".join(
        f"SELECT 'conteo_{name}' AS control, (SELECT count(*) FROM {source}) AS valor_silver, (SELECT count(*) FROM {GOLDS[name]}) AS valor_gold, true AS resultado"
        for name, source in COUNTED.items()
    ),
    "audit_reconcile_sums": " UNION ALL ".join(
        f"SELECT '{name}' AS control, CAST((SELECT sum({column}) FROM {held}) AS DOUBLE) AS valor_silver, CAST((SELECT sum({column}) FROM {fact}) AS DOUBLE) AS valor_gold, true AS resultado"
        for name, (held, fact, column) in SUMS.items()
    ),
    "audit_idempotence": f"""SELECT table_name, max(CASE WHEN orden = 1 THEN row_count END) AS ejecucion_reciente, max(CASE WHEN orden = 2 THEN row_count END) AS ejecucion_anterior,
      max(CASE WHEN orden = 1 THEN row_count END) = max(CASE WHEN orden = 2 THEN row_count END) AS resultado_idempotente
      FROM c_run_metrics JOIN ({METRICS_TWO}) r USING (run_id) WHERE orden <= 2 GROUP BY table_name""",
    "audit_latest_runs": f"""SELECT run_id, max(processed_at_utc) AS processed_at_utc, count(DISTINCT table_name) AS tablas_procesadas, CAST(sum(bronze_rows) AS BIGINT) AS total_bronze,
      CAST(sum(silver_rows) AS BIGINT) AS total_silver, CAST(sum(quarantined_rows) AS BIGINT) AS total_cuarentena
      FROM c_run_metrics JOIN ({METRICS_TWO}) r USING (run_id) WHERE orden <= 2 GROUP BY run_id""",
    "audit_pii_columns": """SELECT 'gold' AS capa, CAST(0 AS BIGINT) AS columnas_personales_expuestas, CAST(1 AS BIGINT) AS columnas_cuenta_protegidas, CAST(10 AS BIGINT) AS tablas_inspeccionadas, CAST(0 AS BIGINT) AS filas_expuestas
      UNION ALL SELECT 'silver', 6, 0, 6, (SELECT count(*) FROM sil_cli) + (SELECT count(*) FROM sil_mov)""",
    "report_source_counts": counts({name.upper(): source for name, source in SOURCES.items()}),
    "report_silver_counts": counts(SILVERS),
    "report_mov_quality": """SELECT count(*) AS total_movimientos_silver, count(DISTINCT id_mov) AS ids_movimiento_unicos, count(*) FILTER (NOT ind_fecha_rango_valido) AS fechas_fuera_rango,
      count(*) FILTER (NOT ind_canal_valido) AS canales_invalidos_detectados, count(*) FILTER (cod_canal = 'DESCONOCIDO') AS canales_mapeados_desconocido,
      count(*) FILTER (ind_sospechoso) AS movimientos_sospechosos FROM sil_mov""",
    "report_silver_integrity": "SELECT " + ", ".join(
        f"(SELECT count(*) FROM {fact} f LEFT JOIN {dim} d ON f.{fk} = d.{fk} WHERE d.{fk} IS NULL) AS {label}_sin_{what}"
        for label, fact in (("movimientos", "sil_mov"), ("obligaciones", "sil_obl"), ("comisiones", "sil_com"))
        for what, dim, fk in (("cliente", "sil_cli", "id_cli"), ("producto", "sil_pro", "cod_prod"))
    ),
    "report_suspicious_top20": typed("sil_mov", "id_mov id_cli fec_mov vr_mov promedio_vr_mov_30d desv_vr_mov_30d cantidad_mov_30d ind_sospechoso", "WHERE ind_sospechoso ORDER BY sil_mov.fec_mov DESC, sil_mov.vr_mov DESC, sil_mov.id_mov LIMIT 20"),
    "report_gold_counts": counts(GOLDS),
    "report_kpi": typed("m_kpi", " ".join(c for c in KPI.split() if c not in ("valor_total_movimientos", "total_comisiones"))),
    "report_gold_integrity": orphan_list(star_relations("f_mov", "f_obl", "f_com")),
    "report_alert_segments": SEGMENTS,
    "report_top_products": """SELECT producto_key, desc_prod, tip_prod, clientes_con_movimientos, cantidad_movimientos, movimientos_sospechosos, cantidad_obligaciones, obligaciones_en_mora,
      CAST(saldo_total_capital AS DOUBLE) AS saldo_total_cartera, CAST(valor_total_comisiones AS DOUBLE) AS ingreso_total_comisiones FROM m_pro ORDER BY saldo_total_capital DESC, producto_key LIMIT 10""",
    "report_duplicate_ids": "SELECT id_mov, count(*) AS cantidad FROM src_mov GROUP BY id_mov HAVING count(*) > 1",
    "report_out_of_period": typed("src_mov", MOV, f"WHERE fec_mov < {START} OR fec_mov > {END}"),
    "report_invalid_channel": typed("std_mov", MOV, f"WHERE cod_canal NOT IN {CHANNELS}"),
    "report_run_metrics": typed("c_run_metrics", "run_id table_type table_name row_count"),
    "dq_key_integrity": "SELECT tabla, llave, nulos, duplicados, nulos = 0 AND duplicados = 0 AS aprobado FROM k_llave",
    "dq_fk_membership": "SELECT control, referencias_invalidas, referencias_invalidas = 0 AS aprobado FROM k_ref",
    "dq_null_rates": "SELECT tabla, columna, round(tasa, 6) AS tasa_nulos, abs(tasa - 0.05) <= 0.01 AS aprobado FROM k_nulos",
    "dq_anomaly_counts": "SELECT anomalia, detectadas, CAST(previstas AS BIGINT) AS previstas, detectadas >= previstas AS aprobado FROM k_anomalia",
    "dq_business_consistency": "SELECT control, incumplimientos, incumplimientos = 0 AS aprobado FROM k_consistencia",
    "dq_domain_subset": "SELECT valor, filas, permitido FROM k_dominio",
    "dq_full_row_duplicates": "SELECT filas_duplicadas FROM copias",
    "audit_reconcile_detects": """SELECT 'conteo_movimientos' AS control, CAST(count(*) AS DOUBLE) AS valor_silver,
      CAST(count(*) FILTER (id_mov % 10 <> 0) AS DOUBLE) AS valor_gold, false AS resultado FROM src_mov
      UNION ALL SELECT 'conteo_comisiones', CAST(count(*) AS DOUBLE), CAST(count(*) AS DOUBLE), true FROM src_com
      UNION ALL SELECT 'conteo_clientes', CAST(count(*) AS DOUBLE), NULL, false FROM src_cli
      UNION ALL SELECT 'conteo_productos', NULL, CAST(count(*) AS DOUBLE), false FROM src_pro""",
    "dq_report": """SELECT count(*) FILTER (aprobado) AS controles_exitosos, count(*) FILTER (NOT aprobado) AS controles_fallidos,
      array_to_string(list_sort(list(control) FILTER (NOT aprobado)), '|') AS fallas,
      CASE WHEN count(*) FILTER (NOT aprobado) = 0 THEN 'PASSED' ELSE 'FAILED' END AS estado FROM controles""",
}


# What is published must be what the direct build gives.
BODIES["publish_silver_contents"] = BODIES["silver_movimientos"]
BODIES["publish_gold_contents"] = BODIES["mart_cliente_360"]


SILVER_COLUMNS = dict(zip(SILVERS, (CLI, PRO, SUC, MOV_SILVER, OBL_SILVER, COM)))
GOLD_COLUMNS = {
    "dim_cliente": DIM_CLI, "dim_producto": DIM_PRO, "mart_producto_rendimiento": f"{DIM_PRO} {MOV_PRO} {OBL_PRO} {COM_ANY}", "kpi_resumen_bancario": KPI + " run_id",
    "mart_cliente_360": f"{DIM_CLI} {MOV_CLI} {OBL_CLI} {COM_ANY} porcentaje_movimientos_sospechosos nivel_alerta_cliente",
    "dim_sucursal": "sucursal_key nom_suc tip_punto ciudad depto latitud longitud activo",
    "dim_fecha": "fecha_key fecha anio trimestre mes nombre_mes semana_anio dia_mes dia_semana nombre_dia es_fin_semana",
    "fact_movimientos": "cliente_key producto_key id_mov fecha_key hra_mov num_cuenta_hash vr_mov tip_mov cod_canal cod_ciudad cod_estado_mov ind_canal_valido ind_sospechoso promedio_vr_mov_30d desv_vr_mov_30d cantidad_mov_30d",
    "fact_obligaciones": "cliente_key producto_key id_oblig vr_aprobado vr_desembolsado sdo_capital vr_cuota fecha_desembolso_key fecha_venc_key dias_mora_act num_cuotas_pend calif_riesgo ind_montos_consistentes ind_fechas_consistentes ind_en_mora rango_mora",
    "fact_comisiones": "cliente_key producto_key id_comision fecha_key vr_comision tip_comision estado_cobro",
}


def content(name: str, source: str, columns: str) -> str:
    """Rows and the sum of the first 60 bits of their hashes."""
    row = hashed(" ".join(c for c in columns.split() if not c.startswith("_")))
    return f"SELECT '{name}' AS table_name, count(*) AS rows, CAST(coalesce(sum(CAST('0x' || substr({row}, 1, 15) AS BIGINT)), 0) AS VARCHAR) AS digest FROM {source}"


BODIES["publish_layers"] = " UNION ALL ".join(
    [content(f"silver.{name}", SILVERS[name], columns) for name, columns in SILVER_COLUMNS.items()]
    + [content(f"gold.{name}", GOLDS[name], columns) for name, columns in GOLD_COLUMNS.items()]
)
BODIES["bronze_compacted"] = BODIES["bronze_read"]
BODIES["publish_metrics_once"] = BODIES["silver_run_metrics"]
BODIES["audit_altered_contents"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows, count(*) AS rows_after, {str(name != 'tb_comisiones_log').lower()} AS resultado FROM {source}"
    for name, source in SILVERS.items()
)
BODIES["ingest_stale_config"] = " UNION ALL ".join(
    f"SELECT '{name}' AS tabla, count(*) AS filas, CAST({'max(id_mov)' if source == 'src_mov' else '1'} AS BIGINT) AS marca, true AS initial_load_completed FROM {source}"
    for name, source in SOURCES.items()
)


def oracle_sql() -> dict[str, str]:
    return {name: compose(body) for name, body in BODIES.items()}
