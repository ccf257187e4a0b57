"""Display text for cards and leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelscope.functions.numbers import rounded


def thousands(value: Column, digits: int = 2) -> Column:
    return F.format_number(rounded(value, digits), digits)


def percent_text(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", rounded(value, digits))


def plain(value: Column, digits: int = 2) -> Column:
    """Shortest decimal text, one decimal at least; whole numbers when digits is 0."""
    if digits == 0:
        return rounded(value, 0).cast("long").cast("string")
    fixed = F.format_string(f"%.{digits}f", rounded(value, digits))
    return F.when(value.isNotNull(), F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1"))


def accounting(value: Column, digits: int = 2) -> Column:
    """Negative amounts in parentheses, without a sign."""
    return F.when(
        rounded(value, digits) < 0, F.concat(F.lit("("), plain(-value, digits), F.lit(")"))
    ).otherwise(plain(value, digits))
