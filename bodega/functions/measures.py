"""Derived measures and codes of the retail model, one Column expression each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: codes and labels the results must carry ---------------------------------
GENDERS = ("M", "F")
GENDER_UNKNOWN = "NO INFORMADO"
DEFAULT_AGE_BAND = "26-35"
STORE_TYPES = (("%HIPER%", "HIPERMERCADO"), ("%SUPER%", "SUPERMERCADO"))
STORE_TYPE_OTHER = "OTROS"
ZONES = {"ECUADOR": "NORTE", "COLOMBIA": "SUR"}
ZONE_OTHER = "CENTRO"
RETURN_REASONS = {"DAM": "Producto Dañado", "ERR": "Error Cliente"}
RETURN_REASON_OTHER = "Otros"
# -------------------------------------------------------------------------------------------

AsOf = dt.date | str | None


def as_of_date(as_of: AsOf) -> Column:
    """The reference date: a date, ISO text, or today when None."""
    if as_of is None:
        return F.current_date()
    return F.lit(dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of)


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0 (null counts as 0)."""
    return F.when(condition, 1).otherwise(0)


def first_match(rules: Iterable[tuple[Column, object]], default: object) -> Column:
    """Value of the first condition that holds, else the default."""
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def recode(code: Column, labels: Mapping[str, str], default: str) -> Column:
    """Label of a code; unknown and null codes get the default."""
    return first_match([(code == key, label) for key, label in labels.items()], default)


def gender(code: Column) -> Column:
    return F.when(code.isin(*GENDERS), code).otherwise(GENDER_UNKNOWN)


def store_type(raw: Column) -> Column:
    return first_match([(F.upper(raw).like(p), label) for p, label in STORE_TYPES], STORE_TYPE_OTHER)


def zone(country: Column) -> Column:
    return recode(F.upper(country), ZONES, ZONE_OTHER)


def net_sale(quantity: Column, price: Column, discount: Column) -> Column:
    """quantity × price − discount, exact; 18 digits keep the decimal in one long."""
    return (quantity * price - discount).cast("decimal(18,4)")


def rate(part: Column, whole: Column) -> Column:
    """100 · part / whole rounded to 2 digits, 0 where whole is not positive."""
    return F.when(whole > 0, F.round(part / whole * 100, 2)).otherwise(F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    """Like ``rate`` for counts: multiplies first, so halves stay exact."""
    return F.coalesce(F.round(F.try_divide(part * 100, whole), 2), F.lit(0.0))


def rfm_label(r: Column, f: Column, m: Column) -> Column:
    return F.concat(F.lit("R"), r, F.lit("-F"), f, F.lit("-M"), m)


def rfm_group(r: Column, f: Column, m: Column, high: int = 4) -> Column:
    return first_match(
        [
            ((r >= high) & (f >= high) & (m >= high), "Champions"),
            (r >= high, "Clientes Recientes"),
            (f >= high, "Frecuentes"),
        ],
        "Estandar",
    )
