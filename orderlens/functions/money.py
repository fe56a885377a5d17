"""Exact money arithmetic: sums and ratios stay DECIMAL, only finished figures become DOUBLE."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(20,2)"  # wide enough for any total, narrow enough to keep 18 digits after a division


def total(col: str | Column) -> Column:
    """Sum of a money column."""
    return F.sum(col).cast(TOTAL)


def line_total(col: str | Column) -> Column:
    """Sum of a line's money column, added up as whole cents in BIGINT: exact below 90 trillion a line."""
    return money(F.sum(cents(col)), TOTAL)


def cents(col: str | Column) -> Column:
    """A money column in whole cents."""
    return F.rint(_column(col).cast("double") * 100).cast("bigint")


def money(whole_cents: Column, to: str = "decimal(12,2)") -> Column:
    """Whole cents as DECIMAL."""
    return (whole_cents.cast("decimal(15,0)") * F.lit(Decimal("0.01"))).cast(to)


def halves_away(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator in whole numbers, halves away from zero; null over zero. ``denominator`` is positive."""
    size = F.abs(numerator) * 2 + denominator
    twice = F.nullif(denominator * 2, F.lit(0))
    return F.when(numerator < 0, -_div(size, twice)).otherwise(_div(size, twice))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def amount(col: str | Column, places: int = 2) -> Column:
    """A DECIMAL figure rounded half away from zero, as DOUBLE."""
    return F.round(col, places).cast("double")


def ratio(numerator: str | Column, denominator: str | Column, places: int = 2) -> Column:
    """numerator / denominator, null over zero."""
    return amount(_divide(numerator, denominator), places)


def percent(numerator: str | Column, denominator: str | Column, places: int = 2) -> Column:
    """numerator / denominator in percent, null over zero."""
    return amount(_divide(_column(numerator) * 100, denominator), places)


def mean(col: str | Column, places: int = 2) -> Column:
    """Average of an exact column over its non-null rows, rounded once."""
    return ratio(F.sum(col), F.count(col), places)


def growth(current: str | Column, previous: str | Column, places: int = 2) -> Column:
    """Change on ``previous`` in percent of its size; null without a previous value or over zero."""
    current, previous = _column(current), _column(previous)
    return percent(current - previous, F.abs(previous), places)


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _divide(numerator: str | Column, denominator: str | Column) -> Column:
    return _column(numerator) / F.nullif(_column(denominator), F.lit(0))
