"""Sums, ratios and rounding with one fixed meaning across the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(value: Column | str) -> Column:
    """Sum in which a group of nulls adds up to zero."""
    return F.coalesce(F.sum(_col(value)), F.lit(0))


def total_when(condition: Column, value: Column | str) -> Column:
    return total(F.when(condition, _col(value)))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double quotient; a zero or missing denominator gives null."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole) * 100


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-even on the scaled double, as numpy and pandas round; applied last.

    Decimal half-even (bround) would settle 1.275, a double just below the tie, otherwise.
    Adding zero turns a negative zero into a plain one.
    """
    scale = float(10**digits)
    return F.rint(value.cast("double") * scale) / scale + F.lit(0.0)


def nonzero_or_null(value: Column | str) -> Column:
    """True for anything but an exact zero; a missing value passes."""
    return F.coalesce(_col(value) != 0, F.lit(True))
