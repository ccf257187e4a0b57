from __future__ import annotations

from datetime import date

import pytest

from parcelscope.plans import lifecycle
from parcelscope.sources import star_schema
from parcelscope.sources.tables import ShipmentTables
from tests.frames import forms, shipments

JAN, FEB, MAR = (date(2024, m, 1) for m in (1, 2, 3))
MONTHS = {"prev1": JAN, "prev": FEB, "cur": MAR}


def dated(spark, *pairs, **more):
    rows = [{"acc_no": a, "normal_cn_date": d} | extra for a, d, extra in pairs]
    frame = shipments(spark, *rows)
    return frame.selectExpr("*", "trunc(normal_cn_date, 'month') as month_start")


def form(acc, first, created=None, finance=None, second=None):
    return {
        "acc_no": acc,
        "first_cn": first,
        "creation_date": created,
        "finance_approval": finance or created,
        "second_approval": second or finance or created,
    }


@pytest.fixture(scope="module")
def table(spark):
    sent = dated(
        spark,
        ("old", JAN, {}), ("old", FEB, {}), ("old", MAR, {}),
        ("gone", FEB, {}), ("back", JAN, {}), ("back", MAR, {}),
        ("new", MAR, {}), ("formless", MAR, {}), (None, MAR, {}), ("late", MAR, {}),
    )
    accounts = forms(
        spark,
        form("old", date(2023, 5, 2), date(2023, 4, 1)),
        form("gone", FEB, FEB),
        form("back", date(2024, 1, 3), date(2023, 12, 1)),
        form("new", MAR, MAR, date(2024, 3, 5), date(2024, 3, 31)),
        form("late", MAR, date(2024, 1, 9), date(2024, 2, 3), date(2024, 2, 4)),
        form("silent", MAR, MAR, date(2024, 3, 2), date(2024, 4, 1)),
        form("idle", None, date(2024, 2, 1), MAR, MAR),
    )
    rows = lifecycle.account_lifecycle(sent, accounts, MONTHS, 2024).collect()
    return {r.ord: (r.prev, r.cur, r.inc_dec) for r in rows}


def test_shipping_rows(table):
    assert table[1] == (2, 6, 4)  # the missing account number counts as one account
    assert table[2] == (1, 4, 3)  # but is nobody in the comparison of months
    assert table[6] == (1, 1, 0)


def test_new_accounts_shipped_in_the_fetched_range(table):
    assert table[3] == (1, 2, 1)  # gone; new and late, but not silent, which never shipped


def test_form_rows(table):
    assert table[7] == (2, 2, 0)
    assert table[8] == (2, 2, 0)
    assert table[9] == (1, 1, 0)
    assert table[11] == (1, 1, 0)
    assert table[12] == (0, 1, 1)


def test_derived_rows(table):
    for i in (0, 1):
        assert table[4][i] == table[2][i] - table[3][i]
        assert table[1][i] == table[2][i] + table[5][i]
        assert table[8][i] == table[9][i] + table[10][i]


def test_lost_accounts_step_over_absent_months(spark):
    """February has no shipments at all, so March follows January."""
    sent = dated(
        spark,
        ("a", JAN, {"sp_name": "P"}), ("b", JAN, {"sp_name": "P"}), ("c", JAN, {"sp_name": "Q"}),
        ("a", MAR, {"sp_name": "P"}), ("b", MAR, {"sp_name": "R"}), ("c", MAR, {"sp_name": "Q"}),
        ("d", JAN, {"sp_name": None}),
    )
    rows = lifecycle.accounts_lost_by_sp(sent, [JAN, FEB, MAR]).collect()
    lost = {(r.sp_name, r.month_start): r.lost_accounts for r in rows}
    assert lost == {("P", MAR): 1, ("Q", MAR): 0}  # b moved to R; R had nobody before


def test_lost_accounts_match_brute_force(spark, tables):
    months = [date(1995, m, 1) for m in range(1, 13)]
    frame = tables.shipments(date(1995, 1, 1), date(1995, 12, 31))
    actual = {
        (r.sp_name, r.month_start): r.lost_accounts
        for r in lifecycle.accounts_lost_by_sp(frame, months).collect()
    }
    seen: dict = {}
    for r in frame.select("sp_name", "acc_no", "month_start").collect():
        seen.setdefault(r.month_start, {}).setdefault(r.sp_name, set()).add(r.acc_no)
    present = sorted(seen)
    expected = {}
    for before, now in zip(present, present[1:]):
        for sp, accounts in seen[before].items():
            expected[sp, now] = len(accounts - seen[now].get(sp, set()))
    assert {k: v for k, v in actual.items() if v or k in expected} == expected


def test_accounts_per_sales_person(spark):
    sent = dated(
        spark,
        ("a", JAN, {"sp_name": "P"}), ("a", FEB, {"sp_name": "Q"}), ("b", FEB, {"sp_name": "P"}),
        ("x", FEB, {"sp_name": "P"}),
    )
    accounts = forms(
        spark,
        form("a", JAN, JAN),
        form("b", FEB, JAN, date(2024, 1, 31), FEB),
    )
    approved = lifecycle.approved_accounts_by_sp(accounts, sent, [JAN, FEB]).collect()
    assert {(r.sp_name, r.month_start): r.accounts for r in approved} == {
        ("P", JAN): 1, ("P", FEB): 0, ("Q", JAN): 1, ("Q", FEB): 0,
    }
    new = lifecycle.new_active_by_sp(sent, accounts, [JAN, FEB]).collect()
    assert {(r.sp_name, r.month_start): r.accounts for r in new} == {("P", JAN): 1, ("P", FEB): 1}


def test_probe_values(spark):
    """Counts at sf0.01 for forms missing by account number (FIXTURES.md section 3)."""
    folder = "/root/testdata/sf0.01"
    source = star_schema.star_schema_tables(spark, folder)

    def read(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    accounts = star_schema.derive_acc_form(read, has_form="c_custkey % 10 <> 9")
    months = {"prev1": date(1995, 2, 1), "prev": date(1995, 3, 1), "cur": date(1995, 4, 1)}
    tables = ShipmentTables.of(salesreport=source.frame("salesreport"), acc_form=accounts)
    frame = lifecycle.account_lifecycle(
        tables.shipments(date(1995, 2, 1), date(1995, 4, 30)), tables.accounts(), months, 1995
    )
    rows = {r.ord: (r.prev, r.cur) for r in frame.collect()}
    probes = {
        1: (561, 554), 2: (341, 327), 3: (203, 115), 7: (148, 84), 8: (130, 81),
        9: (84, 47), 11: (57, 28), 12: (68, 37),
    }
    assert {i: rows[i] for i in probes} == probes
