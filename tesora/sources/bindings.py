"""The six banking source tables, bound to the TPC-H-like test tables.

The SELECT texts are the input definition; they run unchanged in Spark and in
the checking engine, with ``{table}`` standing for an input.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesora.config import (
    CLIENTES,
    COMISIONES,
    MOVIMIENTOS,
    OBLIGACIONES,
    PRODUCTOS,
    SPECS,
    SUCURSALES,
    LakeConfig,
    RunContext,
    TableSpec,
)

SOURCE_SQL: dict[str, str] = {
    CLIENTES: """
SELECT c_custkey AS id_cli, c_name AS nomb_cli, concat('AP', CAST(c_custkey AS VARCHAR(20))) AS apell_cli,
  CASE c_nationkey % 4 WHEN 0 THEN 'cc' WHEN 1 THEN 'CURP' WHEN 2 THEN ' DNI ' ELSE 'RUT' END AS tip_doc,
  lpad(CAST(c_custkey AS VARCHAR(20)), 12, '0') AS num_doc,
  DATE '1945-01-01' + CAST((c_custkey * 37) % 23010 AS INT) AS fec_nac,
  DATE '2016-01-01' + CAST((c_custkey * 11) % 3800 AS INT) AS fec_alta,
  c_mktsegment AS cod_segmento,
  CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE CAST(300 + (c_custkey * 7919) % 551 AS INT) END AS score_buro,
  n_name AS ciudad_res, r_name AS depto_res,
  CASE WHEN c_custkey % 100 < 91 THEN 'ACTIVO' WHEN c_custkey % 100 < 98 THEN 'INACTIVO' ELSE 'BLOQUEADO' END AS estado_cli,
  CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'app' ELSE 'WEB' END AS canal_adquis
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    PRODUCTOS: """
SELECT concat('PRD', CAST(p_partkey AS VARCHAR(20))) AS cod_prod, p_name AS desc_prod, p_type AS tip_prod,
  CAST(p_size AS DECIMAL(8,2)) AS tasa_ea, CAST(p_size AS INT) AS plazo_max_meses,
  CAST(p_retailprice AS DECIMAL(18,2)) AS cuota_min, CAST(p_size AS DECIMAL(18,2)) AS comision_admin,
  CASE WHEN p_size <= 46 THEN 'ACTIVO' ELSE 'INACTIVO' END AS estado_prod
FROM {part}""",
    SUCURSALES: """
SELECT concat('SUC', CAST(s_suppkey AS VARCHAR(20))) AS cod_suc, s_name AS nom_suc,
  CASE s_suppkey % 3 WHEN 0 THEN 'SUCURSAL' WHEN 1 THEN 'CORRESPONSAL' ELSE 'PUNTO_DIGITAL' END AS tip_punto,
  n_name AS ciudad, r_name AS depto, CAST(s_nationkey AS DECIMAL(10,6)) AS latitud, CAST(-s_nationkey AS DECIMAL(10,6)) AS longitud,
  s_acctbal >= 0 AS activo
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    MOVIMIENTOS: """
SELECT event_id AS id_mov, CASE WHEN event_id % 11 = 0 THEN -1 - user_id ELSE user_id END AS id_cli,
  concat(CASE WHEN event_id % 23 = 0 THEN 'PRX' ELSE 'PRD' END, CAST(event_id % 200 AS VARCHAR(20))) AS cod_prod,
  concat('CTA', CAST(user_id AS VARCHAR(20)), '-', CAST(event_id % 200 AS VARCHAR(20))) AS num_cuenta,
  CAST(ts AS DATE) AS fec_mov, substr(CAST(ts AS VARCHAR(40)), 12, 8) AS hra_mov,
  CAST(value AS DECIMAL(18,2)) AS vr_mov, upper(event_type) AS tip_mov, concat(' ', event_type) AS cod_canal,
  concat('C', CAST(user_id % 20 AS VARCHAR(20))) AS cod_ciudad,
  CASE WHEN event_id % 50 = 0 THEN 'REVERSADO' WHEN event_id % 25 = 0 THEN 'RECHAZADO' ELSE 'APROBADO' END AS cod_estado_mov,
  CASE WHEN event_id % 20 = 0 THEN NULL ELSE concat('DEV', CAST(event_id % 997 AS VARCHAR(20))) END AS id_dispositivo
FROM {events}""",
    OBLIGACIONES: """
SELECT l_orderkey * 8 + l_linenumber AS id_oblig, CASE WHEN l_orderkey % 11 = 0 THEN -o_custkey ELSE o_custkey END AS id_cli,
  concat(CASE WHEN l_orderkey % 23 = 0 THEN 'PRX' ELSE 'PRD' END, CAST(l_partkey AS VARCHAR(20))) AS cod_prod,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS vr_aprobado,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) + CAST(0.02 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS vr_desembolsado,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.10 * l_linenumber AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS sdo_capital,
  CAST(l_quantity AS DECIMAL(18,2)) AS vr_cuota, CAST(o_orderdate AS DATE) AS fec_desembolso, CAST(l_shipdate AS DATE) AS fec_venc,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_orderkey % 181 AS INT) ELSE 0 END AS dias_mora_act, CAST(l_linenumber AS INT) AS num_cuotas_pend,
  CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE l_returnflag END AS calif_riesgo,
  CAST(l_shipdate AS DATE) AS _ord1, CAST(l_extendedprice AS DECIMAL(18,2)) AS _ord2, l_partkey AS _ord3, l_suppkey AS _ord4
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    COMISIONES: """
SELECT o_orderkey AS id_comision, CASE WHEN o_orderkey % 11 = 0 THEN -o_custkey ELSE o_custkey END AS id_cli,
  concat(CASE WHEN o_orderkey % 23 = 0 THEN 'PRX' ELSE 'PRD' END, CAST(o_orderkey % 200 AS VARCHAR(20))) AS cod_prod,
  CAST(o_orderdate AS DATE) AS fec_cobro, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(5000 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS vr_comision,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderpriority END AS tip_comision,
  CASE o_orderstatus WHEN 'F' THEN 'COBRADA' WHEN 'O' THEN 'PENDIENTE' ELSE 'REVERSADA' END AS estado_cobro
FROM {orders}""",
}

INPUTS: dict[str, tuple[str, ...]] = {
    CLIENTES: ("customer", "nation", "region"),
    PRODUCTOS: ("part",),
    SUCURSALES: ("supplier", "nation", "region"),
    MOVIMIENTOS: ("events",),
    OBLIGACIONES: ("lineitem", "orders"),
    COMISIONES: ("orders",),
}

# Control tables. The event stream doubles as the log of ingestion runs, and
# suppliers as the tables under ingestion.
CONTROL_SQL: dict[str, str] = {
    "run_log": """
SELECT concat('RUN-', CAST(CAST(floor(event_id / 40) AS BIGINT) AS VARCHAR(20))) AS pipeline_run_id,
  concat('LOTE-', CAST(CAST(floor(event_id / 40) AS BIGINT) AS VARCHAR(20))) AS batch_id,
  concat('Supplier#', lpad(CAST(user_id % 10 AS VARCHAR(20)), 9, '0')) AS source_table, event_id AS seq,
  CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'view' THEN 'SKIPPED' ELSE 'STARTED' END AS status,
  ts AS event_at_utc, user_id * 10 AS rows_read, user_id * 10 - event_id % 3 AS rows_copied, user_id * 1000 AS bytes_written,
  CAST(event_id % 600 AS INT) AS duration_seconds, concat('bronze/', CAST(event_id AS VARCHAR(20))) AS output_path,
  event_id * 3 AS new_watermark, 'copy' AS activity_name, concat('E', CAST(event_id % 7 AS VARCHAR(20))) AS error_code,
  concat('failed at ', CAST(event_id AS VARCHAR(20))) AS error_message, props AS error_details
FROM {events}""",
    "config": """
SELECT 'dbo' AS source_schema, s_name AS source_table,
  CASE WHEN s_suppkey % 3 = 0 THEN 'APPEND_WATERMARK' ELSE 'CHANGE_TRACKING' END AS load_strategy,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'id' END AS primary_key_column,
  CASE WHEN s_suppkey % 3 = 0 THEN 'id' END AS watermark_column,
  CASE WHEN s_suppkey % 3 <> 0 AND s_acctbal >= 0 THEN s_suppkey * 7 END AS last_change_version,
  CASE WHEN s_suppkey % 3 = 0 AND s_acctbal >= 0 THEN s_suppkey * 11 END AS last_watermark_value,
  s_acctbal >= 0 AS initial_load_completed, s_suppkey % 5 <> 0 AS is_active,
  TIMESTAMP '2024-01-01 00:00:00' AS updated_at_utc
FROM {supplier}""",
    "config_changes": """
SELECT 'dbo' AS source_schema, concat('Supplier#', lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0')) AS source_table,
  CASE WHEN c_custkey % 2 = 0 THEN 'APPEND_WATERMARK' ELSE 'CHANGE_TRACKING' END AS load_strategy,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'pk' END AS primary_key_column,
  CASE WHEN c_custkey % 2 = 0 THEN 'pk' END AS watermark_column
FROM {customer}""",
    "client_changes": """
SELECT c_custkey AS id_cli, 5 AS version, 'U' AS op FROM {customer} WHERE c_custkey % 10 = 0
UNION ALL SELECT c_custkey, 8, 'I' FROM {customer} WHERE c_custkey % 10 = 1
UNION ALL SELECT c_custkey, 9, 'D' FROM {customer} WHERE c_custkey % 10 = 2
UNION ALL SELECT c_custkey, 9, 'U' FROM {customer} WHERE c_custkey % 30 = 0""",
    "run_metrics": """
SELECT concat('RUN-', CAST(CAST(ts AS DATE) AS VARCHAR(20))) AS run_id, upper(event_type) AS table_name, 'FACT' AS table_type,
  count(*) AS row_count, count(*) AS bronze_rows, count(CASE WHEN value >= 10 THEN 1 END) AS silver_rows,
  count(CASE WHEN value < 10 THEN 1 END) AS quarantined_rows, max(ts) AS processed_at_utc
FROM {events} GROUP BY CAST(ts AS DATE), upper(event_type)""",
}

CONTROL_INPUTS = {
    "run_log": "events",
    "config": "supplier",
    "config_changes": "customer",
    "client_changes": "customer",
    "run_metrics": "events",
}

RUN = RunContext(run_id="RUN-0001", as_of=datetime(2024, 2, 5), batch_id="1")

# These sources date their versions by other means than files: movements by
# delivery batch, obligations by four columns that together leave no ties.
_TEST_SPECS: dict[str, TableSpec] = {
    **{name: replace(spec, order_columns=("_batch_id",)) for name, spec in SPECS.items()},
    OBLIGACIONES: replace(SPECS[OBLIGACIONES], order_columns=("_ord1", "_ord2", "_ord3", "_ord4")),
}

CONFIG = LakeConfig(
    start_date=date(2024, 1, 3),
    end_date=date(2024, 1, 28),
    cutoff_date=date(2024, 1, 31),
    allowed_channels=("CLICK", "VIEW", "PURCHASE", "SIGNUP"),
    allowed_product_types=("ECONOMY", "STANDARD", "PROMO", "MEDIUM"),
    specs=_TEST_SPECS,
)


# Read schemas, so that planning a query opens no files.
TABLE_SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table as its owner holds it, redelivered movements included."""
    inputs = {t: table(spark, sf_dir, t) for t in INPUTS[name]}
    df = spark.sql(SOURCE_SQL[name], **inputs)
    if name == MOVIMIENTOS:
        # One movement in 300 arrives again in a second batch.
        again = F.when(F.col("id_mov") % 300 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        df = df.select("*", F.explode(again).alias("_batch_id"))
    return df


def control_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = CONTROL_INPUTS[name]
    return spark.sql(CONTROL_SQL[name], **{source: table(spark, sf_dir, source)})


def source_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: source_table(spark, sf_dir, name) for name in SOURCE_SQL}


def bronze_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table with the technical columns landing would have added."""
    df = source_table(spark, sf_dir, name)
    if name != MOVIMIENTOS:
        df = df.selectExpr("*", "1 AS _batch_id")
    return df.selectExpr(
        "*",
        "cast(date_add(DATE '2024-02-01', _batch_id) AS timestamp) AS _ingestion_timestamp_utc",
        f"'{CONFIG.source_system}' AS _source_system",
        f"concat('{name}/batch-', _batch_id, '.parquet') AS _source_file",
    )


def bronze_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: bronze_table(spark, sf_dir, name) for name in SOURCE_SQL}
