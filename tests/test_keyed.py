"""The keyed warehouse: joins without a shuffle, returns under their shipment's month, refreshes by what changed, account sets."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import PARAMS
from parcelscope.catalog import REPORTS, display_types
from parcelscope.plans import account_sets
from parcelscope.review import StagedTables
from parcelscope.sources.keyed import WAITING, KeyedWarehouse
from parcelscope.sources.tables import ShipmentTables
from parcelscope.stored import FIRST, SECOND, landed
from tests.frames import customers, forms, returns, shipments

NAMES = ("salesreport", "returnreport", "acc_form", "crf")
JOINED = ("top_dest_returns", "top_dest_return_weight", "dest_day_zone_matrix", "return_revenue_by_zone", "top_dest_return_revenue")


@pytest.fixture(scope="module")
def tables(tables):
    months = (
        "normal_cn_date between '1995-01-01' and '1995-05-31' "
        "or normal_cn_date between '2000-04-01' and '2000-06-30'"
    )
    frames = {name: tables.frame(name) for name in NAMES}
    for name in ("salesreport", "returnreport"):
        frames[name] = frames[name].where(months)
    return ShipmentTables.of(**frames)


@pytest.fixture(scope="module")
def warehouse(spark, tables, tmp_path_factory):
    return landed(spark, tables, str(tmp_path_factory.mktemp("keyed")), lambda w: (w.rebuild_history(), w.add_account_sets(FIRST)))


def rows(frame):
    names = sorted(frame.columns)
    return sorted(repr(tuple(r[c] for c in names)) for r in frame.collect())


def files(warehouse, name):
    """{month folder: {file: time of writing}}"""
    out = {}
    for path in Path(warehouse.folder, name).rglob("*.parquet"):
        month = next(p for p in path.parts if "=" in p)
        out.setdefault(month, {})[path.name] = os.stat(path).st_mtime_ns
    return out


def test_nothing_is_lost_or_doubled(tables, warehouse):
    for name in ("salesreport", "returnreport"):
        assert rows(warehouse.frame(name).select(*tables.frame(name).columns)) == rows(tables.frame(name))


def test_returns_lie_under_their_shipments_month(warehouse):
    shipped = warehouse.frame("salesreport").select("normal_cn", "month_start")
    wrong = warehouse.frame("returnreport").join(shipped, "normal_cn").where("shipment_month <> month_start")
    assert wrong.count() == 0
    assert {b for _, b in warehouse.folders("returnreport")} == {FIRST, SECOND}
    assert warehouse.frame("returnreport").where(F.col("shipment_month") == F.lit(WAITING)).count() == 0


@pytest.mark.parametrize("name", JOINED)
def test_joins_move_no_shipment_number(spark, tables, warehouse, name):
    """Neither fact is exchanged on the number, in the default mode, with broadcasting off as for sides too large for it."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for key, value in zip(before, ("-1", "false")):
        spark.conf.set(key, value)
    try:
        plan = REPORTS[name](warehouse.tables(with_history=False), PARAMS)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "hashpartitioning(normal_cn" not in plan
    assert "SortMergeJoin [normal_cn" in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert any("return_cn" in s and "PartitionFilters: [isnotnull(shipment_month" in s for s in scans)
    assert all("SelectedBucketsCount" in s for s in scans)
    assert rows(REPORTS[name](warehouse.tables(with_history=False), PARAMS)) == rows(REPORTS[name](tables, PARAMS))


def test_a_refresh_opens_only_what_changed(spark, tables, tmp_path):
    warehouse = landed(spark, tables, str(tmp_path), KeyedWarehouse.rebuild_history)
    warehouse.refresh_history(SECOND)
    full = warehouse.tables(with_history=False).history()
    assert rows(warehouse.frame("mom_history").select(*full.columns)) == rows(full)
    before = files(warehouse, "mom_history")
    old = warehouse.frame("salesreport").where("month_start = '1995-02-01'").orderBy("normal_cn").first()
    late = returns(spark, {"normal_cn": old.normal_cn, "normal_cn_date": date(2000, 6, 9), "return_cn": "late"})
    warehouse.land("third", returns=late)
    touched = warehouse.touched("third").collect()
    assert [(r.acc_no, r.month_start) for r in touched] == [(old.acc_no, date(1995, 2, 1))]
    assert warehouse.refresh_history("third") == [date(1995, 2, 1)]
    after = files(warehouse, "mom_history")
    assert {m for m in after if after[m] != before.get(m)} == {"month_start=1995-02-01"}
    full = warehouse.tables(with_history=False).history()
    assert rows(warehouse.frame("mom_history").select(*full.columns)) == rows(full)
    warehouse.land("empty", returns=late.limit(0))
    assert warehouse.refresh_history("empty") == []


def test_landing_again_changes_nothing(spark, tmp_path):
    warehouse = KeyedWarehouse(spark, str(tmp_path), 3)
    customers(spark, {"acc_no": "A"}).write.parquet(f"{tmp_path}/crf")
    sent = shipments(
        spark, {"normal_cn": "1"}, {"normal_cn": "2", "normal_cn_date": date(2024, 2, 1)}, {"normal_cn": "3", "normal_cn_date": None},
        {"normal_cn": None}, {"normal_cn": None, "acc_no": None},
    )
    back = returns(spark, {"normal_cn": "1"}, {"normal_cn": "2", "normal_cn_date": date(2024, 3, 9)}, {"normal_cn": "9"}, {"normal_cn": "9"}, {"normal_cn": None})
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    for step in ("a", "b", "b", "a", "a", "b"):
        warehouse.land(step, **({"returns": back} if step == "a" else {"shipments": sent}))
        if step == "b":
            got = sorted((r.normal_cn or "", r.shipment_month) for r in warehouse.stored("returnreport").collect())
            assert got == [("", WAITING), ("1", jan), ("2", feb), ("9", WAITING), ("9", WAITING)]
            assert warehouse.stored("salesreport").count() == 5
    assert {b for _, b in warehouse.folders("returnreport")} == {"a"}
    # A batch that comes with fewer rows, and one of them in another month, has no others left; returns follow.
    warehouse.rebuild_history()
    moved = sent.where("normal_cn = '1'").withColumn("normal_cn_date", F.lit(date(2024, 4, 4)))
    warehouse.land("b", shipments=moved)
    assert [r.normal_cn for r in warehouse.stored("salesreport").collect()] == ["1"]
    got = {(r.normal_cn, r.shipment_month) for r in warehouse.stored("returnreport").where("normal_cn is not null").collect()}
    assert got == {("1", date(2024, 4, 1)), ("2", WAITING), ("9", WAITING)}
    assert warehouse.stored("returnreport").count() == 5
    assert warehouse.refresh_history("b") == [jan, feb, date(2024, 4, 1)]
    full = warehouse.tables(with_history=False).history()
    assert rows(warehouse.frame("mom_history").select(*full.columns)) == rows(full)
    with pytest.raises(ValueError):
        warehouse.land("no/folder", shipments=sent)


def test_waiting_returns_move_when_their_shipment_lands(spark, tmp_path):
    warehouse = KeyedWarehouse(spark, str(tmp_path), 3)
    back = returns(spark, {"normal_cn": "1"}, {"normal_cn": "1", "return_cn": "again"}, {"normal_cn": "9"})
    warehouse.land("a", returns=back)
    warehouse.land("b", returns=returns(spark, {"normal_cn": "2"}))
    warehouse.land("c", shipments=shipments(spark, {"normal_cn": "1"}, {"normal_cn": "2", "normal_cn_date": date(2024, 2, 5)}))
    got = sorted((r.normal_cn, r.return_cn, r.shipment_month, r.batch) for r in warehouse.stored("returnreport").collect())
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    assert got == [("1", "again", jan, "a"), ("1", "r", jan, "a"), ("2", "r", feb, "b"), ("9", "r", WAITING, "a")]
    assert {(r.acc_no, r.month_start) for r in warehouse.touched("c").collect()} == {("A", jan), ("A", feb)}
    # Another session finds the same tables, and the number of buckets they were made with.
    spark.sql(f"DROP DATABASE {warehouse.database} CASCADE")
    again = KeyedWarehouse(spark, str(tmp_path), 99)
    assert again.buckets == 3 and rows(again.stored("returnreport")) and again.stored("returnreport").count() == 4
    january = again.tables(with_history=False).returns(date(2024, 1, 1), date(2024, 1, 31))
    assert [r.normal_cn for r in january.collect()] == ["1", "1"]


def test_few_accounts_touch_few_row_groups(spark, tmp_path):
    """A month sorted by account: six of 2,000 accounts lie in a small share of its row groups."""
    warehouse = KeyedWarehouse(spark, str(tmp_path), 2)
    many = shipments(spark, {}).drop("acc_no", "normal_cn").crossJoin(
        spark.range(60_000).selectExpr("concat('C-', lpad(id % 2000, 5, '0')) as acc_no", "cast(id as string) as normal_cn")
    )
    before = spark.conf.get("parquet.block.size", None)
    spark.conf.set("parquet.block.size", str(16 * 1024))
    try:
        warehouse.land("a", shipments=many)
    finally:
        spark.conf.unset("parquet.block.size") if before is None else spark.conf.set("parquet.block.size", before)
    wanted = [f"C-{k:05d}" for k in (3, 400, 401, 1200, 1201, 1999)]
    groups = met = 0
    for path in Path(tmp_path, "salesreport").rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        column = meta.schema.names.index("acc_no")
        for k in range(meta.num_row_groups):
            stats = meta.row_group(k).column(column).statistics
            groups += 1
            met += any(stats.min <= w <= stats.max for w in wanted)
    assert groups >= 20 and met <= 0.4 * groups
    read = warehouse.frame("salesreport").where(F.col("acc_no").isin(wanted))
    assert read.count() == 6 * 30


def test_boards_are_heaps_over_stored_rows(spark, tables, tmp_path):
    staged = StagedTables(spark, tables, str(tmp_path))
    frame = REPORTS["top_customers"](staged, PARAMS)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 8 and plan.count("FileScan") == 8
    assert "Generate" not in plan and all("/board_rows_" in f for f in frame.inputFiles())
    assert rows(frame) == rows(REPORTS["top_customers"](tables, PARAMS))


# --- account sets ---------------------------------------------------------------------------


def test_numbers_are_dense_and_stay(warehouse):
    numbers = {r.acc_no: r.number for r in warehouse._parquet("account_numbers", "acc_no string, number long").collect()}
    assert sorted(numbers.values()) == list(range(len(numbers)))
    warehouse.add_account_sets(SECOND)
    warehouse.rebuild_form_sets()
    more = {r.acc_no: r.number for r in warehouse._parquet("account_numbers", "acc_no string, number long").collect()}
    assert sorted(more.values()) == list(range(len(more)))
    assert numbers.items() <= more.items()


def test_sets_read_no_fact(tables, warehouse):
    warehouse.add_account_sets(SECOND)
    warehouse.rebuild_form_sets()
    frame = account_sets.new_active_by_sp(*warehouse.account_sets(), PARAMS.account_months)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("/account_ships/" in f or "/account_forms/" in f for f in frame.inputFiles())
    assert any("PartitionFilters: [month_start" in s or "PartitionFilters: [isnotnull(month_start" in s for s in scans)
    assert "Python" not in plan
    assert rows(display_types(frame)) == rows(display_types(REPORTS["new_active_by_sp"](tables, PARAMS)))


def odd_tables(spark):
    sent = shipments(
        spark,
        *[{"acc_no": a, "sp_name": s, "normal_cn_date": date(2024, m, 7)} for a, s, m in [
            ("A", "S", 1), ("A", "S", 2), ("A", "T", 3), ("B", "S", 1), ("B", None, 3), (None, "S", 2), (None, "U", 3),
            ("C", "T", 2), ("C", "T", 3), ("D", "V", 3), ("A", "S", 1), ("E", "S", 3), ("F", "S", 2), ("G", "W", 3),
        ]],
        {"acc_no": "A", "normal_cn_date": None},
    )
    day = date(2024, 3, 5)
    asked = forms(
        spark,
        {"acc_no": "A", "creation_date": date(2024, 1, 2), "finance_approval": date(2024, 1, 3), "second_approval": date(2024, 1, 4), "first_cn": date(2024, 1, 5)},
        {"acc_no": "C", "creation_date": date(2024, 1, 9), "finance_approval": date(2024, 1, 9), "second_approval": date(2024, 1, 31), "first_cn": date(2024, 2, 1)},
        {"acc_no": "D", "creation_date": day, "finance_approval": day, "second_approval": day, "first_cn": day},
        {"acc_no": "D", "creation_date": date(2023, 1, 1), "finance_approval": day, "second_approval": day, "first_cn": None},
        {"acc_no": "E", "creation_date": date(2024, 2, 2), "finance_approval": date(2024, 2, 2), "second_approval": date(2024, 2, 29), "first_cn": date(2024, 3, 1)},
        {"acc_no": None, "creation_date": day, "finance_approval": day, "second_approval": day, "first_cn": day},
        {"acc_no": "Z", "creation_date": day},
    )
    return ShipmentTables.of(salesreport=sent, returnreport=returns(spark), acc_form=asked, crf=customers(spark, {"acc_no": "A"}))


@pytest.mark.parametrize("bits", [32768, 2])  # with two bits a bucket, accounts are spread over several
def test_sets_agree_on_odd_accounts(spark, tmp_path, bits, monkeypatch):
    monkeypatch.setattr(account_sets, "BITS", bits)
    params = replace(PARAMS, lifecycle_cur=date(2024, 3, 1), lifecycle_year=2024, account_first=date(2023, 12, 1), account_last=date(2024, 4, 30))
    source = odd_tables(spark)
    warehouse = landed(spark, source, str(tmp_path), lambda w: w.add_account_sets(FIRST))
    warehouse.add_account_sets(SECOND)
    warehouse.rebuild_form_sets()
    ships, said = warehouse.account_sets()
    months = params.account_months
    answers = {
        "account_lifecycle": account_sets.account_lifecycle(ships, said, params.lifecycle_months, 2024),
        "approved_accounts_by_sp": account_sets.approved_accounts_by_sp(ships, said, months),
        "new_active_by_sp": account_sets.new_active_by_sp(ships, said, months),
        "accounts_lost_by_sp": account_sets.accounts_lost_by_sp(ships, months),
    }
    for name, answer in answers.items():
        assert rows(display_types(answer)) == rows(display_types(REPORTS[name](source, params))), name
