"""Parameters of a run: table specifications, business settings, run identity."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

# --- Fixed values -----------------------------------------------------------
# Codes, labels and names that published tables must contain verbatim.
ALLOWED_CHANNELS = ("APP", "WEB", "ATM", "PSE", "ACH", "CORRESPONSAL", "SUCURSAL")
UNKNOWN_CHANNEL = "DESCONOCIDO"
PRODUCT_TYPES = ("CREDITO_CONSUMO", "CREDITO_ROTATIVO", "TARJETA_DIGITAL", "CUENTA_AHORROS")

RULE_NULL_KEY = "LLAVE_PRIMARIA_NULA"
RULE_DUPLICATE = "REGISTRO_DUPLICADO_DESCARTADO"
RULE_NO_CLIENT = "CLIENTE_INEXISTENTE"
RULE_NO_PRODUCT = "PRODUCTO_INEXISTENTE"
RULE_AMOUNTS = "MONTOS_OBLIGACION_INCONSISTENTES"
RULE_DATES = "FECHAS_OBLIGACION_INCONSISTENTES"
RULE_NEGATIVE_FEE = "VALOR_COMISION_NEGATIVO"
RULE_OUT_OF_PERIOD = "FECHA_MOVIMIENTO_FUERA_RANGO"
RULE_BAD_CHANNEL = "CANAL_TRANSACCIONAL_INVALIDO"

CHANGE_TRACKING = "CHANGE_TRACKING"
APPEND_WATERMARK = "APPEND_WATERMARK"

# Columns that must never appear in gold, and the one that replaces them.
PERSONAL_COLUMNS = ("nomb_cli", "apell_cli", "tip_doc", "num_doc", "fec_nac", "num_cuenta")
PROTECTED_ACCOUNT_COLUMN = "num_cuenta_hash"
# ----------------------------------------------------------------------------

CLIENTES = "tb_clientes_core"
PRODUCTOS = "tb_productos_cat"
SUCURSALES = "tb_sucursales_red"
MOVIMIENTOS = "tb_mov_financieros"
OBLIGACIONES = "tb_obligaciones"
COMISIONES = "tb_comisiones_log"

# Newest arrival wins; file name and row position make the order total, so a
# re-run (or a retried task) always keeps the same copy.
ARRIVAL_ORDER = ("_ingestion_timestamp_utc", "_source_file", "_row_index")


@dataclass(frozen=True)
class TableSpec:
    """What the engine needs to know about one source table."""

    name: str
    key: str
    types: dict[str, str]
    uppercase: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    strategy: str = CHANGE_TRACKING
    watermark_column: str | None = None
    order_columns: tuple[str, ...] = ARRIVAL_ORDER
    is_fact: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.types)

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in self.types.items())


_MONEY = "decimal(18,2)"

SPECS: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        TableSpec(
            CLIENTES,
            "id_cli",
            {
                "id_cli": "int", "nomb_cli": "string", "apell_cli": "string", "tip_doc": "string",
                "num_doc": "string", "fec_nac": "date", "fec_alta": "date", "cod_segmento": "string",
                "score_buro": "smallint", "ciudad_res": "string", "depto_res": "string",
                "estado_cli": "string", "canal_adquis": "string",
            },
            uppercase=("tip_doc", "cod_segmento", "estado_cli", "canal_adquis"),
            nullable=("score_buro", "canal_adquis"),
        ),
        TableSpec(
            PRODUCTOS,
            "cod_prod",
            {
                "cod_prod": "string", "desc_prod": "string", "tip_prod": "string", "tasa_ea": "decimal(8,2)",
                "plazo_max_meses": "smallint", "cuota_min": _MONEY, "comision_admin": _MONEY,
                "estado_prod": "string",
            },
            uppercase=("cod_prod", "tip_prod", "estado_prod"),
        ),
        TableSpec(
            SUCURSALES,
            "cod_suc",
            {
                "cod_suc": "string", "nom_suc": "string", "tip_punto": "string", "ciudad": "string",
                "depto": "string", "latitud": "decimal(10,6)", "longitud": "decimal(10,6)",
                "activo": "boolean",
            },
            uppercase=("cod_suc", "tip_punto"),
        ),
        TableSpec(
            MOVIMIENTOS,
            "id_mov",
            {
                "id_mov": "bigint", "id_cli": "int", "cod_prod": "string", "num_cuenta": "string",
                "fec_mov": "date", "hra_mov": "string", "vr_mov": _MONEY, "tip_mov": "string",
                "cod_canal": "string", "cod_ciudad": "string", "cod_estado_mov": "string",
                "id_dispositivo": "string",
            },
            uppercase=("cod_prod", "tip_mov", "cod_canal", "cod_estado_mov"),
            nullable=("id_dispositivo",),
            strategy=APPEND_WATERMARK,
            watermark_column="id_mov",
            is_fact=True,
        ),
        TableSpec(
            OBLIGACIONES,
            "id_oblig",
            {
                "id_oblig": "bigint", "id_cli": "int", "cod_prod": "string", "vr_aprobado": _MONEY,
                "vr_desembolsado": _MONEY, "sdo_capital": _MONEY, "vr_cuota": _MONEY,
                "fec_desembolso": "date", "fec_venc": "date", "dias_mora_act": "int",
                "num_cuotas_pend": "smallint", "calif_riesgo": "string",
            },
            uppercase=("cod_prod", "calif_riesgo"),
            nullable=("calif_riesgo",),
            is_fact=True,
        ),
        TableSpec(
            COMISIONES,
            "id_comision",
            {
                "id_comision": "bigint", "id_cli": "int", "cod_prod": "string", "fec_cobro": "date",
                "vr_comision": _MONEY, "tip_comision": "string", "estado_cobro": "string",
            },
            uppercase=("cod_prod", "tip_comision", "estado_cobro"),
            nullable=("tip_comision",),
            is_fact=True,
        ),
    )
}

# Parents before children; deletes run the other way round.
LOAD_ORDER = (CLIENTES, PRODUCTOS, SUCURSALES, OBLIGACIONES, MOVIMIENTOS, COMISIONES)


@dataclass(frozen=True)
class LakeConfig:
    """Business and physical settings shared by every builder."""

    start_date: date = date(2025, 8, 1)
    end_date: date = date(2026, 8, 24)
    cutoff_date: date = date(2026, 8, 24)
    allowed_channels: tuple[str, ...] = ALLOWED_CHANNELS
    allowed_product_types: tuple[str, ...] = PRODUCT_TYPES
    lookback_days: int = 30
    outlier_sigmas: int = 3
    outlier_min_history: int = 2
    source_system: str = "CORE_RDBMS"
    root: str = "lake"
    # Put before the names of the catalogue's schemas, for lakes that share a catalogue.
    schema_prefix: str = ""
    # Ways a foreign key is spread in lookups, so that one hot client or
    # product never lands in a single task.
    salt_buckets: int = 8
    specs: dict[str, TableSpec] = field(default_factory=lambda: dict(SPECS))


@dataclass(frozen=True)
class RunContext:
    """Identity of one run. Builders take it instead of reading clocks."""

    run_id: str
    as_of: datetime
    batch_id: str | None = None

    @property
    def batch(self) -> str:
        return self.batch_id or self.run_id
