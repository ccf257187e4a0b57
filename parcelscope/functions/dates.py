"""Months are carried as the DATE of their first day; labels are display only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def month_of(day: Column | str) -> Column:
    return F.trunc(F.col(day) if isinstance(day, str) else day, "month")


def same_month(a: Column | str, b: Column | str) -> Column:
    """Year and month agree; null when either date is missing."""
    return month_of(a) == month_of(b)


def label_short(month: Column | str) -> Column:
    return F.date_format(month, "MMM-yy")


# Fixed value: two-digit years from here on belong to the 1900s, those below to the 2000s.
CENTURY_TURN = 69


def parse_label(label: Column | str) -> Column:
    """First day of a `Mon-yy` month text; unreadable text gives null.

    Only for tables that store months as text: the year is spelled out before parsing,
    as Spark reads two digits into the 2000s throughout.
    """
    text = F.col(label) if isinstance(label, str) else label
    year = F.substring(text, 5, 2)
    century = F.when(year >= str(CENTURY_TURN), "19").otherwise("20")
    spelled = F.concat(F.lit("01-"), F.substring(text, 1, 4), century, year)
    well_formed = text.rlike("^[A-Z][a-z]{2}-[0-9]{2}$")
    return F.when(well_formed, F.try_to_timestamp(spelled, F.lit("dd-MMM-yyyy")).cast("date"))


def shift_month(day: date, months: int) -> date:
    """First day of the month `months` away from the month of `day`."""
    index = day.year * 12 + day.month - 1 + months
    return date(index // 12, index % 12 + 1, 1)


def month_end(day: date) -> date:
    return date.fromordinal(shift_month(day, 1).toordinal() - 1)


def month_span(first: date, last: date) -> list[date]:
    """Every month start from the month of `first` to the month of `last`."""
    start = shift_month(first, 0)
    count = (last.year - start.year) * 12 + last.month - start.month + 1
    return [shift_month(start, i) for i in range(count)]


def window_months(end: date, n_months: int) -> tuple[date, date]:
    """First and last month of the `n_months` window closing with the month of `end`."""
    return shift_month(end, 1 - n_months), shift_month(end, 0)
