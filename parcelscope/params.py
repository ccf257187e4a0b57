"""What a review is asked for: months, working days, bands, thresholds, named accounts."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from datetime import date

from pyspark.sql import SparkSession

from parcelscope.functions.dates import month_end, month_span, shift_month, window_months

# Shipment band edges, and the leaderboard thresholds.
BAND_EDGES = (
    0, 50, 100, 500, 1000, 1500, 2000, 2500, 3000, 3500, 4000, 4500, 5000, 10000, 15000, 20000,
)
MIN_SHIPMENTS = 100
MIN_WEIGHT_PER_SHIPMENT = 0.5
TOP_DESTINATIONS = 10
TOP_CUSTOMERS = 5


@dataclass(frozen=True)
class ReviewParams:
    cur: date
    n_months: int = 6
    working_days: dict[date, int] = field(default_factory=dict)
    extract_months: int = 12
    lifecycle_cur: date | None = None
    lifecycle_year: int | None = None
    account_first: date | None = None
    account_last: date | None = None
    band_edges: tuple[int, ...] = BAND_EDGES
    min_shipments: int = MIN_SHIPMENTS
    min_weight_per_shipment: float = MIN_WEIGHT_PER_SHIPMENT
    top_destinations: int = TOP_DESTINATIONS
    top_customers: int = TOP_CUSTOMERS
    key_accounts: tuple[str, ...] = ()
    key_customers: tuple[str, ...] = ()
    key_group: tuple[str, ...] = ()
    key_start: date | None = None
    key_end: date | None = None
    # Report name -> the fields that differ for it.
    reports: dict[str, dict] = field(default_factory=dict)

    def for_report(self, name: str) -> ReviewParams:
        """These parameters with the report's own in their place."""
        return replace(self, **self.reports.get(name, {}), reports={})

    # The three months side by side in the reports.
    @property
    def prev(self) -> date:
        return shift_month(self.cur, -1)

    @property
    def prev1(self) -> date:
        return shift_month(self.cur, -2)

    @property
    def pair(self) -> dict[str, date]:
        return {"prev": self.prev, "cur": shift_month(self.cur, 0)}

    @property
    def triple(self) -> dict[str, date]:
        return {"prev1": self.prev1, **self.pair}

    @property
    def pair_range(self) -> tuple[date, date]:
        """First day of the previous month, last day of the current one."""
        return self.prev, month_end(self.cur)

    @property
    def window(self) -> tuple[date, date]:
        return window_months(self.cur, self.n_months)

    @property
    def extract_window(self) -> tuple[date, date]:
        return window_months(self.cur, self.extract_months)

    @property
    def lifecycle_months(self) -> dict[str, date]:
        last = shift_month(self.lifecycle_cur or self.cur, 0)
        return {"prev1": shift_month(last, -2), "prev": shift_month(last, -1), "cur": last}

    @property
    def lifecycle_end(self) -> date:
        return month_end(self.lifecycle_months["cur"])

    @property
    def account_range(self) -> tuple[date, date]:
        """Range of the accounts tab; a year back to the current month unless given."""
        return (
            self.account_first or shift_month(self.cur, -12),
            self.account_last or month_end(self.cur),
        )

    @property
    def account_months(self) -> list[date]:
        return month_span(*self.account_range)

    @property
    def key_range(self) -> tuple[date, date]:
        return (
            self.key_start or shift_month(self.cur, -12),
            self.key_end or month_end(self.cur),
        )


def _typed(name: str, value):
    kinds = {f.name: str(f.type) for f in fields(ReviewParams)}
    if name not in kinds:
        raise ValueError(f"unknown parameter {name}")
    if value is None:
        return value
    if name == "reports":
        return {report: _given(own) for report, own in value.items() if own is not None}
    if kinds[name].startswith("date"):
        return date.fromisoformat(value)
    if kinds[name].startswith("tuple"):
        return tuple(value)
    if kinds[name].startswith("dict"):
        return {date.fromisoformat(month): days for month, days in value.items() if days is not None}
    return value


def _given(record: dict) -> dict:
    """Fields of ReviewParams; what is null in the file counts as not given."""
    return {name: _typed(name, value) for name, value in record.items() if value is not None}


def load_params(spark: SparkSession, path: str) -> ReviewParams:
    """Read one JSON object whose keys are the fields of ReviewParams, dates as YYYY-MM-DD.

    `reports` holds one object for each report that has parameters of its own, for example
    {"top_customers": {"n_months": 3}, "accounts_lost_by_sp": {"account_first": "2024-01-01"}}.
    """
    record = spark.read.json(path, multiLine=True).first().asDict(recursive=True)
    return ReviewParams(**_given(record))
