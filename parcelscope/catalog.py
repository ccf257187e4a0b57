"""Every report by name: (tables, params) -> DataFrame."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from parcelscope.operators.returns import returned_by_destination
from parcelscope.params import ReviewParams
from parcelscope.plans import customers, destinations, lifecycle, monthly, sales_people, zones
from parcelscope.sources.tables import ShipmentTables

Report = Callable[[ShipmentTables, ReviewParams], DataFrame]
REPORTS: dict[str, Report] = {}


# Display order of the written reports: columns, those with a minus largest first.
_BY_CURRENT = {
    "top_dest_shipments": "shipments_cur", "top_dest_weight": "a_cur", "top_dest_weight_charges": "a_cur",
    "top_dest_revenue": "a_cur", "top_dest_rps": "rps_cur", "top_dest_rpw": "rpw_cur", "top_dest_wps": "ws_cur",
    "top_dest_return_weight": "cur", "top_dest_return_revenue": "cur",
}
_BY_MONTH = (
    "monthly_shipments", "monthly_weight", "monthly_weight_charges", "monthly_other_charges", "monthly_revenue",
    "rps_breakdown", "monthly_rps", "rpw_breakdown", "monthly_rpw", "wps_breakdown", "monthly_wps", "shipment_bands",
)
_BY_MONTH_AND_ORD = (
    "monthly_kpis", "monthly_kpis_mom_diff", "monthly_kpis_mom_pct", "monthly_returns", "monthly_returns_mom_diff",
    "monthly_returns_mom_pct", "key_account_group_trend",
)
_BY_ORD = (
    "account_lifecycle", "return_shipments_by_zone", "weight_by_zone", "return_weight_by_zone",
    "weight_charges_by_zone", "revenue_by_zone_cod", "return_revenue_by_zone",
)
ROW_ORDER: dict[str, tuple[str, ...]] = {
    **{name: (f"-{column}", "master_dest") for name, column in _BY_CURRENT.items()},
    **{name: ("month_start",) for name in _BY_MONTH},
    **{name: ("month_start", "ord") for name in _BY_MONTH_AND_ORD},
    **{name: ("ord",) for name in _BY_ORD},
    "kpi_cards": ("month_start", "slide", "ord"),
    "key_account_trend": ("customer", "month_start", "ord"),
    "top_customers": ("leaderboard", "rank"),
    "top_dest_returns": ("master_dest",),
    "dest_day_zone_matrix": ("-n_s_wc", "master_dest", "normal_cn_date"),
    "approved_accounts_by_sp": ("sp_name", "month_start"),
    "new_active_by_sp": ("sp_name", "month_start"),
    "accounts_lost_by_sp": ("sp_name", "month_start"),
    "sp_customer_scorecard": ("sp_name", "cust_name", "acc_no"),
    "sp_totals": ("sp_name",),
    "sp_list": ("sp_name",),
}


def report(build: Report) -> Report:
    REPORTS[build.__name__] = build
    return build


def _window(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    return tables.history(*params.window)


def _pair(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    return tables.history(params.prev, params.cur)


def _current(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    return tables.history(params.cur, params.cur)


def _cube(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    def build() -> DataFrame:
        return destinations.destination_cube(tables.shipments(*params.pair_range))

    return tables.shared(f"destination_cube_{params.cur:%Y%m}", build)


def _matrix(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    def build() -> DataFrame:
        days = params.pair_range
        return zones.dest_day_sums(tables.shipments(*days), tables.returns(*days))

    return tables.shared(f"dest_day_sums_{params.cur:%Y%m}", build)


def _returned(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    def build() -> DataFrame:
        days = params.pair_range
        return returned_by_destination(
            tables.shipments(*days), tables.returns(*days), list(params.pair.values())
        )

    return tables.shared(f"returned_by_destination_{params.cur:%Y%m}", build)


def _zone_sums(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    def build() -> DataFrame:
        return zones.zone_month_sums(tables.shipments(*params.pair_range), params.pair)

    return tables.shared(f"zone_month_sums_{params.cur:%Y%m}", build)


@report
def mom_history_build(tables, params):
    return tables.history()


@report
def monthly_kpis(tables, params):
    return monthly.monthly_kpis(_window(tables, params)).orderBy("month_start", "ord")


@report
def monthly_kpis_mom_diff(tables, params):
    return monthly.month_diff(monthly.monthly_kpis(_window(tables, params)))


@report
def monthly_kpis_mom_pct(tables, params):
    return monthly.month_change(monthly.monthly_kpis(_window(tables, params)))


@report
def kpi_cards(tables, params):
    return monthly.kpi_cards(_window(tables, params))


@report
def monthly_returns(tables, params):
    return monthly.monthly_returns(_window(tables, params)).orderBy("month_start", "ord")


@report
def monthly_returns_mom_diff(tables, params):
    return monthly.month_diff(monthly.monthly_returns(_window(tables, params)))


@report
def monthly_returns_mom_pct(tables, params):
    return monthly.month_change(monthly.monthly_returns(_window(tables, params)))


@report
def account_lifecycle(tables, params):
    months = params.lifecycle_months
    shipments = tables.account_months(months["prev1"], params.lifecycle_end)
    year = params.lifecycle_year or months["cur"].year
    return lifecycle.account_lifecycle(shipments, tables.accounts(), months, year)


@report
def approved_accounts_by_sp(tables, params):
    return lifecycle.approved_accounts_by_sp(
        tables.accounts(), tables.account_months(), params.account_months
    )


@report
def new_active_by_sp(tables, params):
    shipments = tables.account_months(*params.account_range)
    return lifecycle.new_active_by_sp(shipments, tables.accounts(), params.account_months)


@report
def accounts_lost_by_sp(tables, params):
    shipments = tables.account_months(*params.account_range)
    return lifecycle.accounts_lost_by_sp(shipments, params.account_months)


@report
def top_dest_shipments(tables, params):
    return destinations.top_by_shipments(
        _cube(tables, params), params.pair, params.top_destinations
    )


@report
def monthly_shipments(tables, params):
    return monthly.sum_series(_window(tables, params), "shipments")


@report
def return_shipments_by_zone(tables, params):
    history = tables.history(params.prev1, params.cur)
    return zones.return_shipments_by_zone(history, params.triple)


@report
def top_dest_returns(tables, params):
    return destinations.top_by_returns(
        _returned(tables, params), params.pair, params.top_destinations
    )


@report
def weight_by_zone(tables, params):
    return zones.weight_by_zone(_pair(tables, params), params.pair, params.working_days)


@report
def top_dest_weight(tables, params):
    return destinations.top_by_zone_a(
        _cube(tables, params), "weight", params.pair, params.top_destinations
    )


@report
def monthly_weight(tables, params):
    return monthly.sum_series(_window(tables, params), "n_wght")


@report
def return_weight_by_zone(tables, params):
    return zones.return_weight_by_zone(_pair(tables, params), params.pair)


@report
def top_dest_return_weight(tables, params):
    return destinations.top_by_return_weight(
        _returned(tables, params), params.pair, params.top_destinations
    )


@report
def weight_charges_by_zone(tables, params):
    return zones.weight_charges_by_zone(_zone_sums(tables, params), params.pair, params.working_days)


@report
def top_dest_weight_charges(tables, params):
    return destinations.top_by_zone_a_with_share(
        _cube(tables, params), "charges", params.pair, params.top_destinations
    )


@report
def monthly_weight_charges(tables, params):
    return monthly.sum_series(_window(tables, params), "n_wght_chgs")


@report
def monthly_other_charges(tables, params):
    return monthly.sum_series(_window(tables, params), "n_oth_chgs")


@report
def revenue_by_zone_cod(tables, params):
    return zones.revenue_by_zone_cod(_zone_sums(tables, params), params.pair, params.working_days)


@report
def top_dest_revenue(tables, params):
    return destinations.top_by_zone_a_with_share(
        _cube(tables, params), "revenue", params.pair, params.top_destinations
    )


@report
def monthly_revenue(tables, params):
    return monthly.sum_series(_window(tables, params), "n_rev")


@report
def dest_day_zone_matrix(tables, params):
    return zones.dest_day_zone_matrix(_matrix(tables, params))


@report
def return_revenue_by_zone(tables, params):
    return zones.return_revenue_by_zone(_matrix(tables, params), params.pair)


@report
def top_dest_return_revenue(tables, params):
    return destinations.top_by_return_revenue(
        _matrix(tables, params), params.pair, params.top_destinations
    )


@report
def rps_breakdown(tables, params):
    return monthly.rps_breakdown(_window(tables, params))


@report
def top_dest_rps(tables, params):
    return destinations.top_by_ratio(
        _cube(tables, params), "rps", "revenue", "shipments", params.pair, params.top_destinations
    )


@report
def monthly_rps(tables, params):
    return monthly.monthly_rps(_window(tables, params))


@report
def rpw_breakdown(tables, params):
    return monthly.rpw_breakdown(_window(tables, params))


@report
def top_dest_rpw(tables, params):
    return destinations.top_by_ratio(
        _cube(tables, params), "rpw", "revenue", "weight", params.pair, params.top_destinations
    )


@report
def monthly_rpw(tables, params):
    return monthly.monthly_rpw(_window(tables, params))


@report
def wps_breakdown(tables, params):
    return monthly.wps_breakdown(_window(tables, params))


@report
def top_dest_wps(tables, params):
    return destinations.top_by_ratio(
        _cube(tables, params), "ws", "weight", "shipments", params.pair, params.top_destinations
    )


@report
def monthly_wps(tables, params):
    return monthly.monthly_wps(_window(tables, params))


@report
def shipment_bands(tables, params):
    return customers.shipment_bands(_window(tables, params), params.band_edges)


def _key_months(tables: ShipmentTables, params: ReviewParams) -> DataFrame:
    def build() -> DataFrame:
        return customers.key_account_months(
            tables.shipments(*params.key_range),
            tables.customers(),
            params.key_accounts,
            *params.key_range,
        )

    # Both trends ask for the same accounts and days, unless one has parameters of its own.
    asked = f"{params.key_accounts}{params.key_range}"
    return tables.shared(f"key_account_months_{zlib.crc32(asked.encode()):08x}", build)


@report
def key_account_trend(tables, params):
    return customers.key_account_trend(_key_months(tables, params), params.key_customers)


@report
def key_account_group_trend(tables, params):
    return customers.key_account_group_trend(_key_months(tables, params), params.key_group)


@report
def top_customers(tables, params):
    def build() -> DataFrame:
        return customers.board_rows(
            _window(tables, params),
            tables.revenue(*params.window),
            params.min_shipments,
            params.min_weight_per_shipment,
        )

    asked = f"{params.window}{params.min_shipments}{params.min_weight_per_shipment}"
    rows = tables.shared(f"board_rows_{zlib.crc32(asked.encode()):08x}", build)
    ranked = customers.top_customers_by_heaps if tables.keeps_shared else customers.top_customers
    return ranked(rows, params.top_customers)


@report
def customer_metrics(tables, params):
    return customers.customer_metrics(_window(tables, params), tables.revenue(*params.window))


@report
def all_data_extract(tables, params):
    return customers.all_data_extract(tables.history(*params.extract_window))


@report
def sp_customer_scorecard(tables, params):
    def build() -> DataFrame:
        return sales_people.sp_customer_sums(_current(tables, params))

    return sales_people.sp_customer_scorecard(tables.shared(f"sp_customer_sums_{params.cur:%Y%m}", build))


@report
def sp_totals(tables, params):
    return sales_people.sp_totals(_current(tables, params))


@report
def sp_list(tables, params):
    return tables.sales_people()


def display_types(frame: DataFrame) -> DataFrame:
    """Decimals as doubles and all integers as longs: the types a report is compared in."""
    widened = {"int": "long", "smallint": "long", "tinyint": "long"}
    columns = []
    for name, kind in frame.dtypes:
        target = "double" if kind.startswith("decimal") else widened.get(kind, kind)
        columns.append(F.col(name).cast(target).alias(name) if target != kind else F.col(name))
    return frame.select(columns)
