"""Run a whole review: stage what many reports share, then write every report."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelscope.catalog import REPORTS, ROW_ORDER
from parcelscope.functions.dates import month_end, month_span, shift_month
from parcelscope.params import ReviewParams
from parcelscope.sinks.writers import write_csv, write_per_customer, write_sheet
from parcelscope.sources.tables import ShipmentTables
from parcelscope.sources.warehouse import read_table, write_table


def staging_folder(spark: SparkSession, fallback: str) -> str:
    """A fresh folder that all executors reach: in the cluster's spark.checkpoint.dir, else in `fallback`.

    On a cluster a path without a scheme, or of one machine's own disk, would differ from machine to
    machine, so that is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = fallback
        master = spark.sparkContext.master
        alone = master.startswith("local") and "cluster" not in master
        if not alone and ("://" not in root or root.startswith("file:")):
            raise ValueError(f"set spark.checkpoint.dir: {root} need not be the same folder on all machines")
    return f"{root}/parcelscope/{uuid.uuid4().hex}"


class StagedTables(ShipmentTables):
    """Tables whose shared intermediates are written out once and read back.

    A lost executor then costs its running tasks, never a recomputation from the
    shipments, and the reports scan small files instead of the same months again.
    Nothing is staged before a report asks for it.
    """

    keeps_shared = True

    def __init__(self, spark: SparkSession, source: ShipmentTables, folder: str):
        super().__init__(source.frame, source.has_history, source.returns_dated)
        self._spark = spark
        self._folder = folder
        self._months: set[date] = set()  # of the history, as far as it is staged

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._frames:
            path = f"{self._folder}/{name}"
            build().write.parquet(path)
            self._frames[name] = self._spark.read.parquet(path)
        return self._frames[name]

    def account_months(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Whole months come from one staged table of all months; the reports ask five times."""
        if start is not None and (start != shift_month(start, 0) or end != month_end(end)):
            return super().account_months(start, end)
        staged = self.shared("account_months", lambda: super(StagedTables, self).account_months().distinct())
        if start is None:
            return staged
        return staged.where(F.col("month_start").between(F.lit(start), F.lit(end)))

    def history(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """As the source's; what it does not store is rolled up once for each month asked for."""
        if self.has_history:
            return super().history(first, last)
        if first is None:
            write_table(super().history(), self._folder, "mom_history")
            self.has_history = True
            self._frames["mom_history"] = read_table(self._spark, self._folder, "mom_history")
            return super().history()
        asked = month_span(first, last)
        missing = [m for m in asked if m not in self._months]
        if missing:
            # Neighbouring months are one job; months between them that are there already are not done again.
            runs = [[missing[0]]]
            for month in missing[1:]:
                if month == shift_month(runs[-1][-1], 1):
                    runs[-1].append(month)
                else:
                    runs.append([month])
            for run in runs:
                write_table(super().history(run[0], run[-1]), self._folder, "mom_history")
            self._months.update(missing)
        stored = read_table(self._spark, self._folder, "mom_history")
        return stored.where(F.col("month_start").between(F.lit(asked[0]), F.lit(asked[-1])))

    def revenue(self, first: date, last: date):
        return self.history(first, last).agg(F.sum("n_rev").cast("double")).scalar()


def run_review(
    spark: SparkSession,
    tables: ShipmentTables,
    params: ReviewParams,
    folder: str,
    names: Iterable[str] | None = None,
) -> dict[str, list[str]]:
    """Write the named reports (all by default) under `folder`; returns the paths written.

    Each report is computed once, into Parquet; its other forms are written from there.
    """
    staged = StagedTables(spark, tables, staging_folder(spark, f"{folder}/_staging"))
    written: dict[str, list[str]] = {}
    for name in names or REPORTS:
        sheet = write_sheet(REPORTS[name](staged, params.for_report(name)), folder, name)
        table, order = spark.read.parquet(sheet), ROW_ORDER.get(name, ())
        written[name] = [write_csv(table, folder, name, order), sheet]
        if name == "key_account_trend":
            written[name].append(write_per_customer(table, folder, name, order=order))
    return written
