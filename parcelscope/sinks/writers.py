"""Report writers. A report is computed once, into its typed form; the others are written from that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _sorted_by(order: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(c[1:]) if c.startswith("-") else F.asc(c) for c in order]


def write_sheet(report: DataFrame, folder: str, name: str) -> str:
    """The typed form of a report, what a workbook sheet holds for the reader. Money stays decimal."""
    path = f"{folder}/report={name}/parquet"
    report.write.mode("overwrite").parquet(path)
    return path


def write_csv(report: DataFrame, folder: str, name: str, order: Sequence[str] = ()) -> str:
    """The rows in display order, over all files of the folder."""
    path = f"{folder}/report={name}/csv"
    rows = report.orderBy(*_sorted_by(order)) if order else report
    rows.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_per_customer(
    report: DataFrame, folder: str, name: str, customer: str = "customer", order: Sequence[str] = ()
) -> str:
    """One folder with one CSV file per customer, all written by the same job.

    A customer's rows of a trend are a few per month, so one task holds them.
    """
    path = f"{folder}/report={name}/by_customer"
    rows = report.repartition(customer).sortWithinPartitions(customer, *_sorted_by(order))
    rows.write.mode("overwrite").option("header", True).partitionBy(customer).csv(path)
    return path
