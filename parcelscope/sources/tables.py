"""The five logical tables and the scans the reports make of them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from parcelscope.functions.dates import label_short, month_end, month_of, shift_month
from parcelscope.plans.history import build_history


class ShipmentTables:
    """Lazy frames, each built when a report first asks for it.

    `load` maps a table name of parcelscope.schema to its frame. Without a stored
    account-by-month table (`has_history`), that one is derived from the others.
    `returns_dated` states that every return row repeats the date of its shipment, which
    lets a dated report read the returns of its own months only; leave it off where that
    is not certain (`misdated_returns` tells) and all returns are read.
    """

    keeps_shared = False  # whether `shared` stores what it builds, so that reading it again is cheap

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        has_history: bool = False,
        returns_dated: bool = False,
    ):
        self._load = load
        self._frames: dict[str, DataFrame] = {}
        self.has_history = has_history
        self.returns_dated = returns_dated

    @classmethod
    def of(cls, **frames: DataFrame) -> ShipmentTables:
        return cls(frames.__getitem__, has_history="mom_history" in frames)

    def frame(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    def shipments(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Shipments dated start to end, both included, with their `month_start`.

        A table laid out by month_start is pruned to the months of the range as well.
        """
        frame = self.frame("salesreport")
        in_range = F.col("normal_cn_date").between(F.lit(start), F.lit(end))
        if "month_start" in frame.columns:
            if start is not None:
                months = F.lit(shift_month(start, 0)), F.lit(shift_month(end, 0))
                return frame.where(F.col("month_start").between(*months) & in_range)
            return frame
        if start is not None:
            frame = frame.where(in_range)
        return frame.withColumn("month_start", month_of("normal_cn_date"))

    def returns(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Returns of the shipments dated start to end, or a superset of them.

        Returns stored under the month of their shipment are pruned to the months of the range. Else,
        where a return may be dated apart from its shipment, the shipments' own numbers choose the
        rows, before anything is summed over all returns ever made.
        """
        frame = self.frame("returnreport")
        if start is None:
            return frame
        if "shipment_month" in frame.columns:
            months = F.lit(shift_month(start, 0)), F.lit(shift_month(end, 0))
            return frame.where(F.col("shipment_month").between(*months))
        if not self.returns_dated:
            return frame.join(self.shipments(start, end).select("normal_cn"), "normal_cn", "left_semi")
        if "month_start" in frame.columns:
            months = F.lit(shift_month(start, 0)), F.lit(shift_month(end, 0))
            frame = frame.where(F.col("month_start").between(*months))
        return frame.where(F.col("normal_cn_date").between(F.lit(start), F.lit(end)))

    def misdated_returns(self) -> DataFrame:
        """Returns whose date is not that of their shipment."""
        shipped = self.frame("salesreport").select("normal_cn", "normal_cn_date")
        return self.frame("returnreport").join(
            shipped.withColumnRenamed("normal_cn_date", "shipped_on"), "normal_cn"
        ).where(~F.col("shipped_on").eqNullSafe(F.col("normal_cn_date")))

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """An intermediate several reports read. Nothing is kept here: see review.StagedTables."""
        return build()

    def account_months(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """acc_no, sp_name and month_start of the shipments dated start to end; rows may repeat."""
        return self.shipments(start, end).select("acc_no", "sp_name", "month_start")

    def revenue(self, first: date, last: date) -> Column:
        """Revenue of the months first to last as one value, from one narrow scan."""
        if self.has_history:
            sums = self.history(first, last).agg(F.sum("n_rev").cast("double"))
        else:
            dated = self.shipments(shift_month(first, 0), month_end(last))
            sums = dated.agg(F.sum("normal_revenue").cast("double"))
        return sums.scalar()

    def accounts(self) -> DataFrame:
        return self.frame("acc_form")

    def customers(self) -> DataFrame:
        return self.frame("crf")

    def history(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """Account-by-month rows of the months first to last, both included."""
        if not self.has_history:
            span = (first, month_end(last)) if first is not None else (None, None)
            frame = build_history(self.shipments(*span), self.returns(*span), self.customers())
        else:
            frame = self.frame("mom_history")
            if "month" not in frame.columns:
                frame = frame.withColumn("month", label_short("month_start"))
        if first is None:
            return frame
        months = F.lit(shift_month(first, 0)), F.lit(shift_month(last, 0))
        return frame.where(F.col("month_start").between(*months))

    def sales_people(self) -> DataFrame:
        """Distinct sales-person names, without white space at either end, in capitals."""
        name = F.upper(F.regexp_replace("sp_name", r"(?U)^\s+|\s+$", "")).alias("sp_name")
        return self.account_months().select(name).distinct()
