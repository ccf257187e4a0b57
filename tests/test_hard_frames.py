"""Reports and check SQL over hand-made tables with what the raw tables never hold.

Shipments without a number, with an empty or a shared one; a month without shipments; shipments
returned twice, returns without a number, dated elsewhere or without a shipment. Null sales persons
and destinations are in the edge-frame tests of each report.
"""

from __future__ import annotations

import random
from datetime import date, timedelta

import duckdb
import pytest

from __spark_entry__ import PARAMS
from check_sql import base
from check_sql.reports import ORACLES
from parcelscope.catalog import REPORTS, display_types
from parcelscope.sources.tables import ShipmentTables
from parcelscope.sources.warehouse import read_table, write_table
from tests.frames import customers, forms, returns, shipments

# The map from account to customer is one to one here; the SQL joins without reducing it.
HAND = {
    base.SHIPMENTS: "ship AS (SELECT *, CAST(date_trunc('month', normal_cn_date) AS DATE) AS month_start FROM hand_ship)",
    base.RETURNS: "ret AS (SELECT * FROM hand_ret)",
    base.CUSTOMERS: "crf AS (SELECT * FROM hand_crf)",
    base.FORMS: "forms AS (SELECT * FROM hand_forms)",
}
SKIPPED = {"sp_list"}  # the names of the raw tables have no white space but blanks


def rows(frame):
    names = sorted(frame.columns)
    return sorted(repr(tuple(r[c] for c in names)) for r in frame.collect())


@pytest.fixture(scope="module")
def hand(spark, tmp_path_factory):
    rng = random.Random(11)
    months = [date(1995, 2, 1), date(1995, 4, 1), date(2000, 2, 1), date(2000, 3, 1), date(2000, 5, 1), date(2000, 6, 1)]
    accounts = [*PARAMS.key_accounts, "C-1", "C-2", "C-3", "C-4"]
    sent, back = [], []
    for i in range(500):
        day = rng.choice(months) + timedelta(days=rng.randrange(28))
        number = rng.choice([None, ""]) if i % 25 == 0 else f"n{i}"
        sent.append({
            "normal_cn": number, "normal_cn_date": day, "acc_no": rng.choice(accounts),
            "sp_name": rng.choice(["S1", "S2", "S3"]), "origin": rng.choice("PQR"),
            "dest": rng.choice("PQRT"), "master_dest": rng.choice("DEFGHIJKLMNO"), "dest_zone": rng.choice("ABC"),
            "weight": rng.randrange(1, 400) / 100, "normal_weight_charges": rng.randrange(1, 99), "normal_fsc": rng.randrange(9),
            "normal_other_charges": rng.randrange(9), "normal_revenue": rng.randrange(10, 200), "cod": rng.choice([0, 0, 7]),
        })
        for k in range(rng.choice([0, 0, 1, 1, 2, 3])):
            moved = day + timedelta(days=rng.choice([0, 0, 0, 40, -40]))
            back.append({
                "normal_cn": number, "normal_cn_date": moved, "return_cn": rng.choice([None, "", f"r{i}-{k}", f"r{i}-{k}"]),
                "return_weight_charges": rng.choice([0, 5, 12]),
            })
    back += [{"normal_cn": f"lost{i}"} for i in range(9)]
    papers = [
        {"acc_no": a, "creation_date": date(1995, 1 + i % 4, 3), "finance_approval": date(1995, 2 + i % 3, 9),
         "second_approval": date(1995, 2 + i % 3, 20), "first_cn": date(1995, 2 + i % 3, 1)}
        for i, a in enumerate(accounts)
    ]
    number = {a: f"Customer#{int(a[2:]):09d}" for a in accounts}
    frames = {
        "salesreport": shipments(spark, *[s | {"normal_cn": s["normal_cn"]} for s in sent]),
        "returnreport": returns(spark, *back),
        "acc_form": forms(spark, *papers),
        "crf": customers(spark, *[{"acc_no": a, "cust_name": n} for a, n in number.items()]),
    }
    folder = str(tmp_path_factory.mktemp("hand"))
    for name, frame in frames.items():
        write_table(frame, folder, name)
    duck = duckdb.connect()
    for view, name in (("hand_ship", "salesreport"), ("hand_ret", "returnreport"), ("hand_crf", "crf"), ("hand_forms", "acc_form")):
        columns = ", ".join(f for f in frames[name].columns)
        files = f"{folder}/{name}/**/*.parquet"
        duck.execute(f"CREATE TABLE {view} AS SELECT {columns} FROM read_parquet('{files}', hive_partitioning=false)")
    tables = ShipmentTables(lambda name: read_table(spark, folder, name))
    return tables, duck


@pytest.mark.parametrize("name", sorted(set(REPORTS) - SKIPPED))
def test_report_matches_sql(hand, name):
    tables, duck = hand
    sql = ORACLES[name]
    for raw, own in HAND.items():
        sql = sql.replace(raw, own)
    expected = duck.sql(sql)
    result = display_types(REPORTS[name](tables, PARAMS))
    names = sorted(result.columns)
    order = [expected.columns.index(c) for c in names]
    wanted = sorted(repr(tuple(row[i] for i in order)) for row in expected.fetchall())
    assert rows(result) == wanted
