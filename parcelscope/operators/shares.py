"""Parts of a whole without a second scan.

The whole travels as one more row of the same aggregate (GROUPING SETS) and is read back
once the table has shrunk to a few report rows. The windows here have no partition key;
they only ever see such a finished table: zones plus a total, or twice the top n plus one.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F


def whole_of(value: Column | str, is_total: str = "is_total") -> Column:
    """The value on the total row, repeated on every row of a report-sized table."""
    cell = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(F.col(is_total), cell)).over(Window.partitionBy())


def sum_of_all(value: Column | str) -> Column:
    """Grand total of a report-sized table, repeated on every row."""
    return F.sum(value).over(Window.partitionBy())
