from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelscope.plans import customers, sales_people
from parcelscope.plans.history import build_history
from parcelscope.sources.tables import ShipmentTables
from tests.frames import customers as crf
from tests.frames import history, returns, shipments

JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def test_bands_keep_empties_and_the_overflow_stays_in_the_base(spark):
    frame = history(
        spark,
        {"shipments": 0, "n_wght": 0, "n_rev": 0},
        {"shipments": 20000, "n_wght": 50, "n_rev": 60},
        {"shipments": 60, "n_wght": 30, "n_rev": 40},
        {"shipments": 70, "n_wght": 20, "n_rev": 0, "acc_no": None},
    )
    rows = {r.band: r for r in customers.shipment_bands(frame, (0, 50, 100, 20000)).collect()}
    assert list(rows) == ["0-50", "50-100", "100-20000"]
    full = rows["50-100"]
    assert (full.customers, full.customers_pct) == (1, "33.33%")
    assert (full.shipments, full.shipments_pct) == (130, "0.65%")
    assert (full.revenue_pct, full.rps, full.rpw, full.ws) == ("40.00%", 20.0, 0.8, 25.0)
    empty = rows["100-20000"]
    assert (empty.customers, empty.weight_pct, empty.rps, empty.rpw) == (0, "0.00%", 0.0, 0.0)
    assert rows["0-50"].rpw == 0.0


def test_leaderboards(spark):
    frame = history(
        spark,
        {"acc_no": "A", "cust_name": "a", "shipments": 100, "n_rev": 1000, "n_wght": 50,
         "n_s_zb": 10, "ret_ship": 5, "ret_revenue": 12},
        {"acc_no": "A", "cust_name": "a", "month_start": FEB, "shipments": 200, "n_rev": 900,
         "n_wght": 100, "n_s_zb": 100},
        {"acc_no": "B", "cust_name": "b", "shipments": 150, "n_rev": 100, "n_wght": 74.6},
        {"acc_no": "C", "cust_name": "c", "shipments": 99, "n_rev": 8000, "n_wght": 990},
    )
    rows = customers.top_customers(customers.board_rows(frame, ShipmentTables.of(mom_history=frame).revenue(JAN, FEB), 100, 0.5), 2).collect()
    boards = {}
    for r in rows:
        boards.setdefault(r.leaderboard, {})[r.rank] = r
    assert len(boards) == 8
    ships = boards["Top5Shipments"]
    assert [ships[i].total_shipments for i in (1, 2)] == ["200", "150"]  # B rounds up to 0.5
    assert ships[1].revenue_pct == "9.00%"  # of all rows, C among them
    assert [boards["Top5RPS"][i].rps for i in (1, 2)] == [10.0, 4.5]
    assert [boards["Top5LowestRPS"][i].rps for i in (1, 2)] == [0.67, 4.5]
    assert boards["Top5ZBShipments"][1].zone_share == "50.00%"
    best = boards["Top5HighestReturnRatio"][1]
    assert (best.return_ratio, best.return_tariff, best.weight) == ("5.00%", 2.0, "50.00")


def test_equal_scores_rank_by_account(spark):
    frame = history(spark, *[{"acc_no": a, "shipments": 5, "n_wght": 5} for a in "CABD"])
    whole = F.lit(0.0)
    rows = customers.top_customers(customers.board_rows(frame, whole, 1, 0), 3).where("leaderboard = 'Top5Shipments'")
    metrics = customers.customer_metrics(frame, whole)
    assert metrics.count() == 4
    assert rows.count() == 3


def test_extract_writes_a_return_line_where_something_came_back(spark):
    frame = history(
        spark,
        {"acc_no": "A", "shipments": 3, "n_rev": 10, "n_fsc": 2, "ret_ship": 1, "ret_revenue": 4},
        {"acc_no": "B", "shipments": 3},
        {"acc_no": "C", "shipments": 3, "ret_ship": None},
    )
    rows = customers.all_data_extract(frame).collect()
    assert sorted((r.acc_no, r.type) for r in rows) == [
        ("A", "Normal"), ("A", "Return"), ("B", "Normal"), ("C", "Normal"), ("C", "Return"),
    ]
    lines = {r.type: r for r in rows if r.acc_no == "A"}
    assert lines["Normal"].revenue_without_fsc == Decimal("8")
    assert (lines["Return"].revenue, lines["Return"].fsc) == (Decimal("4"), Decimal("0"))
    assert len(rows[0]) == 13


def test_key_accounts(spark):
    sent = shipments(
        spark,
        {"acc_no": "A", "normal_cn_date": date(2023, 12, 20)},
        {"acc_no": "A", "weight": 2, "normal_revenue": 10},
        {"acc_no": "A", "weight": 3, "normal_revenue": 10},
        {"acc_no": "B", "weight": 5, "normal_revenue": 20},
        {"acc_no": "Z"},
    ).selectExpr("*", "trunc(normal_cn_date, 'month') as month_start")
    names = crf(spark, *[{"acc_no": a, "cust_name": f"cust {a}"} for a in "ABZ"])
    months = customers.key_account_months(
        sent, names, ["A", "B"], date(2023, 12, 15), date(2024, 1, 31)
    )
    assert {(r.acc_no, r.month_start) for r in months.collect()} == {("A", JAN), ("B", JAN)}
    trend = customers.key_account_trend(months, ["cust A"]).orderBy("ord").collect()
    assert [r.value for r in trend] == [2.0, 5.0, 20.0, 10.0, 4.0, 2.5]
    merged = customers.key_account_group_trend(months, ["cust A", "cust B"]).orderBy("ord")
    assert [r.value for r in merged.collect()] == [3.0, 10.0, 40.0, 13.33, 4.0, 3.33]


def test_scorecard_divides_by_the_rows_own_sales_person(spark):
    frame = history(
        spark,
        {"acc_no": "A", "sp_name": "P", "n_rev": 30, "shipments": 10, "n_wght": 4, "n_s_za": 5, "r_s_za": 1},
        {"acc_no": "B", "sp_name": "P", "n_rev": 10, "shipments": 0, "n_s_za": 3},
        {"acc_no": "C", "sp_name": "Q", "n_rev": 60, "shipments": 1, "n_wght": 24},
        {"acc_no": "D", "sp_name": None, "n_rev": 900, "n_s_za": 90},
    )
    rows = {r.acc_no: r for r in sales_people.sp_customer_scorecard(sales_people.sp_customer_sums(frame)).collect()}
    assert set(rows) == {"A", "B", "C"}
    assert (rows["A"].revenue_share_sp, rows["A"].revenue_share_total) == (75.0, 30.0)
    assert rows["C"].revenue_share_sp == 100.0
    assert (rows["A"].rps, rows["A"].rpw, rows["A"].ws) == (3.0, 8.0, 0.0)
    assert rows["C"].rpw == 2.0  # 2.5 rounds to even
    assert rows["A"].zone_a_return_pct == 12.5
    assert (rows["B"].za_pct, rows["B"].rps) == (0.0, 0.0)


def test_sp_totals(spark):
    frame = history(
        spark,
        {"shipments": 6, "n_s_wc": 1, "n_s_za": 2, "kg_0_0_5": 1, "kg_0_5_1_0": 2},
        {"shipments": 2, "acc_no": "B", "n_s_wc": 1},
    )
    row = sales_people.sp_totals(frame).first()
    assert (row.wc_pct, row.za_pct, row.kg_0_1_pct) == (25.0, 25.0, 37.5)


@pytest.fixture(scope="module")
def rolled(spark):
    sent = shipments(
        spark,
        {"weight": 0.5, "normal_revenue": 10},
        {"weight": 0.6, "normal_revenue": 20, "origin": "Y"},
        {"weight": 4, "normal_revenue": 5, "dest_zone": "C", "cod": 7},
        {"acc_no": None, "weight": 1},
        {"normal_cn_date": FEB, "weight": 1},
    ).selectExpr("*", "trunc(normal_cn_date, 'month') as month_start")
    back = returns(
        spark,
        {"normal_cn": "n3", "return_weight_charges": 3},
        {"normal_cn": "n3", "return_weight_charges": 4},
        {"normal_cn": "n1", "return_weight_charges": 0},
        {"normal_cn": "n2", "return_cn": ""},
    )
    names = crf(spark, {"acc_no": "A", "cust_name": "first"}, {"acc_no": "A", "cust_name": "second"})
    return build_history(sent, back, names).collect()


def test_roll_up_counts_a_shipment_once(rolled):
    row = next(r for r in rolled if r.acc_no == "A" and r.month_start == JAN)
    assert (row.shipments, row.n_rev, row.n_wght, row.cod) == (3, 35, Decimal("5.10"), 7)
    assert (row.n_s_wc, row.n_s_za, row.n_s_zb, row.n_s_zc) == (1, 1, 0, 1)
    assert (row.ret_ship, row.r_s_za, row.r_s_zc, row.r_s_chrg, row.r_s_nchrg) == (2, 1, 1, 1, 1)
    assert (row.ret_revenue, row.r_wght_chrg, row.r_wght_nchrg) == (7, 4, Decimal("0.50"))
    assert (row.kg_0_0_5, row.kg_0_5_1_0, row.month, row.cust_name) == (1, 1, "Jan-24", "first")


def test_roll_up_keeps_unknown_accounts_and_all_months(rolled):
    assert len(rolled) == 3
    unknown = next(r for r in rolled if r.acc_no is None)
    assert (unknown.shipments, unknown.cust_name) == (1, None)


def test_parts_add_up(tables):
    row = tables.history().selectExpr(
        "sum(shipments - n_s_wc - n_s_za - n_s_zb - n_s_zc) as ships",
        "sum(n_wght - n_wght_wc - n_wght_za - n_wght_zb - n_wght_zc) as weight",
        "sum(ret_ship - r_s_chrg - r_s_nchrg) as charged",
        "sum(n_rev - n_wght_chgs - n_fsc - n_oth_chgs) as revenue",
    ).first()
    assert (row.ships, row.weight, row.charged, row.revenue) == (0, 0, 0, 0)
