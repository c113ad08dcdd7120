"""Scalar building blocks. Every function takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SEPARATOR = "\u001f"
NULL_MARK = "\u2205"


def date_key(day: Column) -> Column:
    """Calendar key as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def banker_round(amount: Column, scale: int = 2, precision: int = 18) -> Column:
    """Half-even rounding, stored as a decimal of fixed scale."""
    return F.bround(amount, scale).cast(f"decimal({precision},{scale})")


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """Row-level ratio; null unless the denominator is above zero."""
    return F.when(denominator > 0, F.try_divide(numerator, denominator))


def divide(numerator: Column, denominator: Column) -> Column:
    """Measure ratio as double; null for a zero or null denominator."""
    bottom = denominator.cast("double")
    return numerator.cast("double") / F.nullif(bottom, F.lit(0.0))


def text_key(*parts: Column) -> Column:
    """Composite key as text; a null part stays distinct from an empty one."""
    return F.concat_ws(UNIT_SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_MARK)) for p in parts])


# --- fixed values: display formats ------------------------------------------
WHOLE = "#,##0"
DOLLARS = "$#,##0.00"
PERCENT = "0.00%"
MULTIPLE = "0.00x"
SHORT_DATE = "Short Date"


def display(value: Column, pattern: str) -> Column:
    """Value as display text; null stays null."""
    if pattern == WHOLE:
        return F.format_number(value, 0)
    if pattern == DOLLARS:
        text = F.concat(F.lit("$"), F.format_number(F.abs(value), 2))
        return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)
    if pattern == PERCENT:
        return F.when(value.isNotNull(), F.concat(F.format_string("%.2f", value * 100), F.lit("%")))
    if pattern == MULTIPLE:
        return F.when(value.isNotNull(), F.concat(F.format_string("%.2f", value), F.lit("x")))
    if pattern == SHORT_DATE:
        return F.date_format(value, "M/d/yyyy")
    raise ValueError(f"unknown display format {pattern!r}")
