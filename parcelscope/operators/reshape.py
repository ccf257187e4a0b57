"""Wide to long, months side by side, month-on-month change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelscope.functions.numbers import ratio


def to_long(
    wide: DataFrame,
    ids: Sequence[str],
    metrics: Sequence[str],
    name: str = "metric",
    value: str = "value",
) -> DataFrame:
    """One row per metric; values become doubles so that counts and money share a column."""
    doubles = [F.col(m).cast("double").alias(m) for m in metrics]
    return wide.select(*ids, *doubles).unpivot(list(ids), list(metrics), name, value)


def with_order(long: DataFrame, metrics: Sequence[str], name: str = "metric") -> DataFrame:
    """Add `ord`, the fixed display position of each metric."""
    position = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col(name))
    return long.withColumn("ord", position.cast("int"))


def at_month(value: Column | str, month: date, month_column: str = "month_start") -> Column:
    """The single value a group holds for one month; null when the month is absent."""
    cell = F.col(value) if isinstance(value, str) else value
    return F.max(F.when(F.col(month_column) == F.lit(month), cell))


def side_by_side(
    rows: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    months: Mapping[str, date],
    fill: float | None = None,
) -> DataFrame:
    """Months as columns `<value>_<role>`, from rows unique per key and month."""
    cells = []
    for value in values:
        for role, month in months.items():
            cell = at_month(value, month)
            if fill is not None:
                cell = F.coalesce(cell, F.lit(fill))
            cells.append(cell.alias(f"{value}_{role}"))
    wanted = F.col("month_start").isin(*months.values())
    return rows.where(wanted).groupBy(*keys).agg(*cells)


def counts_by_month(
    rows: DataFrame,
    key: str,
    name: str,
    months: Sequence[date],
    condition: Column | None = None,
) -> DataFrame:
    """Rows per key and listed month, zero included, for every key that has a row.

    One shuffle on the key, with partial counts: the months are columns until the end.
    """
    counted = F.lit(True) if condition is None else condition
    labels = [m.isoformat() for m in months]
    counts = [
        F.count_if(counted & (F.col("month_start") == F.lit(m))).alias(label)
        for m, label in zip(months, labels)
    ]
    long = rows.groupBy(key).agg(*counts).unpivot([key], labels, "_label", name)
    return long.select(key, F.to_date("_label").alias("month_start"), name)


def month_on_month(long: DataFrame, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """Each metric beside its value in the previous month that has rows.

    A metric has one row per month, so a window group is no longer than the calendar.
    """
    ordered = Window.partitionBy(*keys).orderBy("month_start")
    return (
        long.withColumn("prev_month", F.lag("month_start").over(ordered))
        .withColumn("prev_value", F.lag("value").over(ordered))
        .where(F.col("prev_month").isNotNull())
        .withColumn("diff", F.col("value") - F.col("prev_value"))
        .withColumn("pct_chng", ratio("value", "prev_value") - 1)
    )
