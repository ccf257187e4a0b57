"""The physical plans that decide whether a report survives a thousand times the data."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import PARAMS
from parcelscope.catalog import REPORTS
from parcelscope.sources.tables import ShipmentTables
from parcelscope.sources.warehouse import stored_schema

DATED = {
    "top_dest_shipments", "top_dest_weight", "top_dest_weight_charges", "top_dest_revenue",
    "top_dest_rps", "top_dest_rpw", "top_dest_wps", "weight_charges_by_zone",
    "revenue_by_zone_cod", "dest_day_zone_matrix", "return_revenue_by_zone",
    "top_dest_return_revenue", "top_dest_returns", "top_dest_return_weight",
    "account_lifecycle", "new_active_by_sp", "accounts_lost_by_sp", "key_account_trend",
}
RANKED = {name for name in DATED if name.startswith("top_dest")} - {"top_dest_return_revenue"}
# Windows without a partition key, and the most rows each can meet.
REPORT_SIZED_WINDOWS = {
    "weight_charges_by_zone": "zones plus one",
    "revenue_by_zone_cod": "zones plus one",
    "top_dest_weight_charges": "twice the top n plus one",
    "top_dest_revenue": "twice the top n plus one",
    "shipment_bands": "bands plus one",
    "sp_customer_scorecard": "sales persons",
}


@pytest.fixture(scope="module")
def plans(spark, tmp_path_factory):
    """Plans over stored tables with broadcasting off, as for sides too large for it."""
    folder = tmp_path_factory.mktemp("empty")

    def load(name):
        path = str(folder / name)
        spark.createDataFrame([], stored_schema(name)).write.parquet(path)
        return spark.read.schema(stored_schema(name)).parquet(path)

    tables = ShipmentTables(load, has_history=True, returns_dated=True)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield {
            name: REPORTS[name](tables, PARAMS)._jdf.queryExecution().executedPlan().toString()
            for name in REPORTS
        }
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_stays_in_the_jvm_and_never_pairs_all_rows(plans, name):
    for node in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert node not in plans[name]


@pytest.mark.parametrize("name", sorted(DATED))
def test_dates_and_months_reach_the_scan(plans, name):
    scans = [s for s in plans[name].splitlines() if "FileScan" in s and "normal_cn_date" in s]
    assert scans
    assert all("GreaterThanOrEqual(normal_cn_date" in s or "month_start" in s for s in scans)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_history_reads_only_its_months_and_columns(plans, name):
    scans = [s for s in plans[name].splitlines() if "FileScan" in s and "n_rev_za" in s]
    if name in ("mom_history_build", "rps_breakdown", "rpw_breakdown"):
        return
    assert not scans


@pytest.mark.parametrize("name", sorted(RANKED | {"top_customers"}))
def test_ranking_is_cut_before_the_shuffle(plans, name):
    assert "WindowGroupLimit" in plans[name]


def test_overall_top_is_a_heap_per_task(plans):
    assert "TakeOrderedAndProject" in plans["top_dest_return_revenue"]


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_unpartitioned_windows_are_the_listed_ones(plans, name):
    single = re.search(r"Window \[[^\n]*windowspecdefinition\((?:specifiedwindowframe)", plans[name])
    assert bool(single) == (name in REPORT_SIZED_WINDOWS)


@pytest.mark.parametrize(
    "name, shuffles",
    {
        "monthly_kpis": 2,
        "kpi_cards": 2,
        "account_lifecycle": 3,
        "accounts_lost_by_sp": 3,
        "top_dest_rps": 5,
        "dest_day_zone_matrix": 4,
        "top_customers": 2,
        "all_data_extract": 0,
        "sp_totals": 1,
    }.items(),
)
def test_shuffles(plans, name, shuffles):
    assert len(re.findall(r"Exchange (?:hash|range|Single)", plans[name])) == shuffles


@pytest.mark.parametrize("name", ["account_lifecycle", "dest_day_zone_matrix", "top_dest_rps"])
def test_sums_start_before_the_shuffle(plans, name):
    assert "partial_" in plans[name]


@pytest.mark.parametrize(
    "name",
    ["top_dest_returns", "top_dest_return_weight", "dest_day_zone_matrix", "return_revenue_by_zone", "top_dest_return_revenue"],
)
def test_returns_dated_elsewhere_are_chosen_before_they_are_summed(spark, tmp_path, name):
    def load(table):
        spark.createDataFrame([], stored_schema(table)).write.mode("overwrite").parquet(str(tmp_path / table))
        return spark.read.schema(stored_schema(table)).parquet(str(tmp_path / table))

    tables = ShipmentTables(load, has_history=True)
    plan = REPORTS[name](tables, PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "return_cn" in line and "Relation" in line)
    above = [i for i, line in enumerate(lines[:at]) if "LeftSemi" in line]
    assert above
    assert not any("Aggregate [normal_cn" in line for line in lines[above[-1] : at])


@pytest.mark.parametrize("name, scans", {"top_customers": 2, "customer_metrics": 2}.items())
def test_whole_comes_from_a_narrow_scan(plans, name, scans):
    """One scan of the report's columns; the whole reads the revenue of the same months, or reuses the shuffle."""
    wide = [line for line in plans[name].splitlines() if "FileScan" in line and "shipments" in line]
    assert len(wide) <= scans


def test_the_scorecard_reads_its_history_once(plans):
    """The sums, and the wholes over them, come out of one shuffle."""
    plan = plans["sp_customer_scorecard"]
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan
