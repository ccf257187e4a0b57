"""Best rows overall and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_group(
    rows: DataFrame,
    group: Sequence[str],
    metric: str,
    n: int,
    ties: Sequence[str],
    rank: str = "rank",
) -> DataFrame:
    """The n largest non-null metrics of each group; equal metrics rank by `ties`.

    Filtering on row_number lets Spark cut every input partition to n rows per group
    before the shuffle (WindowGroupLimit), so a large group never meets in one task.
    """
    ordered = Window.partitionBy(*group).orderBy(F.desc(metric), *[F.asc(t) for t in ties])
    return (
        rows.where(F.col(metric).isNotNull())
        .withColumn(rank, F.row_number().over(ordered))
        .where(F.col(rank) <= n)
    )


def top_k(rows: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return rows.orderBy(*order).limit(k)
