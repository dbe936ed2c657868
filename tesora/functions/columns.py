"""Reusable column expressions, all evaluated by Spark's own functions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the date dimension.
MONTH_NAMES = (
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
)
DAY_NAMES = ("DOMINGO", "LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO")

# Band edges and labels.
AGE_EDGES = (25, 35, 45, 55, 65)
AGE_LABELS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
SCORE_EDGES = (500, 650, 750)
SCORE_LABELS = ("MUY_BAJO", "BAJO", "MEDIO", "ALTO")
SCORE_UNKNOWN = "SIN_INFORMACION"
ARREARS_EDGES = (0, 30, 60, 90)
ARREARS_LABELS = ("AL_DIA", "MORA_1_30", "MORA_31_60", "MORA_61_90", "MORA_MAYOR_90")
ALERT_LEVELS = ("ALTO", "MEDIO", "BAJO")

# Fixed value: how an absent value enters a record hash.
NULL_TOKEN = "<NULL>"
HASH_SEPARATOR = "||"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def date_key(value: Column | str) -> Column:
    """A date as the integer yyyyMMdd, by arithmetic rather than text."""
    day = as_column(value)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def label_at(labels: Sequence[str], position: Column) -> Column:
    """The label at a 1-based position."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), position)


def bucket(
    value: Column | str,
    edges: Sequence[int],
    labels: Sequence[str],
    null_label: str | None = None,
    inclusive: bool = False,
) -> Column:
    """Band a number: below (or at, if inclusive) each edge in turn, else the last label.

    A null fails every comparison and so takes the last label, unless
    ``null_label`` says otherwise.
    """
    col = as_column(value)
    banded = F.when(col.isNull(), null_label) if null_label is not None else None
    for edge, label in zip(edges, labels):
        test = col <= edge if inclusive else col < edge
        banded = F.when(test, label) if banded is None else banded.when(test, label)
    return banded.otherwise(labels[-1])


def age_at(birth: Column | str, cutoff: date) -> Column:
    """Completed years at the cutoff (month-end aware, as months_between is)."""
    return F.floor(F.months_between(F.lit(cutoff), as_column(birth)) / 12).cast("int")


def percentage(part: Column | str, whole: Column | str, when_zero: float | None = None) -> Column:
    """100 * part / whole at two decimals; ``when_zero`` where there is no whole."""
    ratio = F.round(F.try_divide(as_column(part) * 100, as_column(whole)), 2)
    if when_zero is None:
        return ratio
    return F.when(as_column(whole) > 0, ratio).otherwise(F.lit(when_zero))


def alert_level(arrears_days: Column | str, suspicious: Column | str) -> Column:
    days, hits = as_column(arrears_days), as_column(suspicious)
    high, medium, low = ALERT_LEVELS
    return F.when((days > 90) | (hits >= 10), high).when((days > 30) | (hits > 0), medium).otherwise(low)


def pseudonym(value: Column | str) -> Column:
    return F.sha2(as_column(value), 256)


def is_technical(name: str) -> bool:
    """Columns the engine adds, as opposed to those the source owns."""
    return name.startswith("_")


def business_columns(columns: Iterable[str]) -> list[str]:
    return [name for name in columns if not is_technical(name)]


def record_hash(df: DataFrame) -> Column:
    """SHA-256 over the business columns in name order, nulls made visible."""
    parts = [f"coalesce(cast(`{name}` AS string), '{NULL_TOKEN}')" for name in sorted(business_columns(df.columns))]
    return F.expr(f"sha2(concat_ws('{HASH_SEPARATOR}', {', '.join(parts)}), 256)")
