"""Column expressions: parsing, text, money and rounding.

All are built-in JVM expressions, so they stay inside whole-stage code
generation. Money is decimal from the first expression on: sums are exact and do
not depend on the order in which partitions are merged.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tulha.model import ALERT_FACTOR, DATE_FORMATS, EXACT, VALUE

CENT = Decimal("0.01")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- parsing -----------------------------------------------------------------
_DATE_FIELDS = {"%Y": r"(\d{4})", "%m": r"(\d{1,2})", "%d": r"(\d{1,2})"}


def _read_date(c: Column, layout: str) -> Column:
    """Date of a text value in one layout of %Y, %m and %d; null when it does not fit.

    The shape is tested first and the value then put in ISO order for the fast
    built-in cast. A pattern parser would raise and swallow an exception for
    every value in another layout, which costs far more than reading it.
    """
    shape, places = "^" + layout + "$", {}
    for place, name in enumerate(sorted(_DATE_FIELDS, key=layout.index), start=1):
        shape = shape.replace(name, _DATE_FIELDS[name])
        places[name] = place
    iso = f"${places['%Y']}-${places['%m']}-${places['%d']}"
    return F.when(c.rlike(shape), F.regexp_replace(c, shape, iso).try_cast("date"))


def parse_date(c: Column | str, formats: list[str] = DATE_FORMATS) -> Column:
    """Date of a text value, each value tried against every format in turn."""
    return F.coalesce(*[_read_date(_col(c), f) for f in formats])


def parse_number(c: Column | str) -> Column:
    """Decimal of a text value with either decimal mark, to ten places; null when unreadable."""
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast(EXACT)


def parse_integer(c: Column | str) -> Column:
    """Whole number of a text value, also when written with a zero fraction (5.0)."""
    whole = _col(c).rlike(r"^\s*[+-]?\d+(\.0*)?\s*$")
    return F.when(whole, F.regexp_replace(_col(c), r"\.0*\s*$", "").try_cast("bigint"))


# --- text --------------------------------------------------------------------
def only_digits(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\D", "")


def format_cnpj(c: Column | str) -> Column:
    """Company id as XX.XXX.XXX/XXXX-XX when it has 14 digits, else its digits."""
    return F.regexp_replace(
        only_digits(c), r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", r"$1.$2.$3/$4-$5"
    )


# --- rounding ----------------------------------------------------------------
def half_up(c: Column | str, digits: int) -> Column:
    """Round a ratio half away from zero, over its decimal value."""
    return F.round(_col(c).cast("decimal(38,8)"), digits).cast("double")


def half_even(c: Column | str, digits: int) -> Column:
    """Round a ratio half to even, over its decimal value."""
    return F.bround(_col(c).cast("decimal(38,8)"), digits).cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """Quotient of two exact values as double; null when the divisor is zero."""
    divisor = _col(b).cast("double")
    return _col(a).cast("double") / F.when(divisor != 0, divisor)


def percent(a: Column | str, b: Column | str, digits: int) -> Column:
    return half_up(ratio(a, b) * 100, digits)


def money(c: Column | str) -> Column:
    """Report form of a money value: two places, as double."""
    return F.round(_col(c), 2).cast("double")


def dbl(c: Column | str) -> Column:
    return _col(c).cast("double")


# --- business formulas -------------------------------------------------------
def discounted(value: Column | str, percent_off: Column | str) -> Column:
    """value less a percentage, rounded to cents."""
    return F.round(_col(value) * (F.lit(100) - _col(percent_off)) * F.lit(CENT), 2)


def sales_line_total(qty: Column, price: Column, percent_off: Column) -> Column:
    return F.round(qty * price * (F.lit(1) - percent_off * F.lit(CENT)), 2).cast(VALUE)


def line_total(qty: Column, price: Column) -> Column:
    return F.round(qty * price, 2).cast(VALUE)


def signed_quantity(kind: Column, qty: Column) -> Column:
    """Receipts and adjustments keep their sign; every other movement takes stock out."""
    return F.when(kind.isin("ENTRADA", "AJUSTE"), qty).otherwise(-F.abs(qty))


def margin_percent(cost: Column | str, price: Column | str) -> Column:
    return percent(_col(price) - _col(cost), price, 2)


def stock_status(balance: Column, minimum: Column) -> Column:
    return (
        F.when(balance <= minimum, "CRITICO")
        .when(balance <= minimum * F.lit(Decimal(ALERT_FACTOR)), "ALERTA")
        .otherwise("OK")
    )


def not_in(c: Column | str, values: list[str]) -> Column:
    """True when the value is outside the set; a null is outside too."""
    return ~F.coalesce(_col(c).isin(values), F.lit(False))
