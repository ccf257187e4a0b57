from __future__ import annotations

import csv
from dataclasses import replace
from datetime import date
from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from __spark_entry__ import PARAMS
from parcelscope.catalog import REPORTS, ROW_ORDER, display_types
from parcelscope.params import load_params
from parcelscope.review import StagedTables, run_review, staging_folder
from parcelscope.sinks.writers import write_per_customer
from parcelscope.schema import MOM_HISTORY
from parcelscope.sources.tables import ShipmentTables
from parcelscope.sources.warehouse import (
    conform,
    jdbc_tables,
    read_table,
    refresh_history,
    stored_schema,
    warehouse_tables,
    write_table,
)
from tests.frames import customers, history, returns, shipments

NAMES = ("salesreport", "returnreport", "acc_form", "crf")
FIRST, LAST = date(2000, 4, 1), date(2000, 6, 1)


@pytest.fixture(scope="module")
def tables(tables):
    """The months the reports under test read; a folder per month is slow to write."""
    months = (
        "normal_cn_date between '1995-02-01' and '1995-04-30' "
        "or normal_cn_date between '2000-01-01' and '2000-06-30'"
    )
    frames = {name: tables.frame(name) for name in NAMES}
    for name in ("salesreport", "returnreport"):
        frames[name] = frames[name].where(months)
    return ShipmentTables.of(**frames)


@pytest.fixture(scope="module")
def warehouse(spark, tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warehouse"))
    for name in NAMES:
        write_table(tables.frame(name), folder, name)
    write_table(tables.history(), folder, "mom_history")
    return folder


def rows(frame):
    names = sorted(frame.columns)
    return sorted(repr(tuple(r[c] for c in names)) for r in frame.collect())


@pytest.mark.parametrize("name", [*NAMES, "mom_history"])
def test_tables_survive_the_warehouse(spark, tables, warehouse, name):
    stored = read_table(spark, warehouse, name)
    assert stored.schema.names == stored_schema(name).names
    source = tables.history() if name == "mom_history" else tables.frame(name)
    assert rows(stored.select(*source.columns)) == rows(source)


@pytest.mark.parametrize("returns_dated", [False, True])
@pytest.mark.parametrize(
    "name",
    ["monthly_returns", "top_dest_returns", "top_dest_revenue", "account_lifecycle", "top_customers"],
)
def test_reports_agree_over_either_source(spark, tables, warehouse, name, returns_dated):
    stored = warehouse_tables(spark, warehouse, returns_dated=returns_dated)
    assert rows(REPORTS[name](stored, PARAMS)) == rows(REPORTS[name](tables, PARAMS))


def test_stored_months_are_pruned(spark, warehouse):
    frame = warehouse_tables(spark, warehouse).shipments(FIRST, date(2000, 6, 30))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_start" in plan


def test_refresh_replaces_only_its_months(spark, warehouse, tmp_path):
    folder = str(tmp_path)
    write_table(read_table(spark, warehouse, "mom_history"), folder, "mom_history")
    before = rows(read_table(spark, folder, "mom_history"))
    refresh_history(warehouse_tables(spark, warehouse), folder, FIRST, LAST)
    assert rows(read_table(spark, folder, "mom_history")) == before


def test_a_return_dated_elsewhere_is_reported_and_still_counted(spark):
    sent = shipments(spark, {}, {})
    back = returns(
        spark,
        {"normal_cn": "n1", "normal_cn_date": date(2024, 1, 5)},
        {"normal_cn": "n2", "normal_cn_date": date(2024, 3, 9)},
    )
    tables = ShipmentTables.of(salesreport=sent, returnreport=back)
    assert [r.normal_cn for r in tables.misdated_returns().collect()] == ["n2"]
    assert tables.returns(date(2024, 1, 1), date(2024, 1, 31)).count() == 2


def test_tables_kept_by_others_are_conformed(spark):
    """Months as text, numbers as wider types, optional columns missing."""
    plain = history(spark, {"month": "May-24", "shipments": 3}).drop("month_start")
    row = conform(plain, "mom_history").first()
    assert (row.month_start, row.shipments) == (date(2024, 5, 1), 3)
    bare = spark.createDataFrame([("A", "a", 1)], "acc_no string, cust_name string, other int")
    assert conform(bare, "crf").first().asDict() == {
        "acc_no": "A", "cust_name": "a", "cust_type": None,
    }
    with pytest.raises(AnalysisException):
        conform(bare, "acc_form")


def test_staging_uses_the_clusters_folder():
    def session(settings, master="spark://host"):
        return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))

    named = session({"spark.checkpoint.dir": "/shared/ckpt"})
    first, second = staging_folder(named, "/out"), staging_folder(named, "/out")
    assert first.startswith("/shared/ckpt/parcelscope/") and first != second
    assert staging_folder(session({}, "local[4]"), "/out").startswith("/out/parcelscope/")
    assert staging_folder(session({}), "hdfs://nn/out").startswith("hdfs://nn/out/parcelscope/")
    for path in ("/out", "file:///out"):
        with pytest.raises(ValueError):
            staging_folder(session({}), path)


def test_review_writes_what_the_reports_hold(spark, tables, tmp_path):
    names = ["monthly_kpis", "top_dest_shipments", "top_dest_rps", "key_account_trend"]
    written = run_review(spark, tables, PARAMS, str(tmp_path), names)
    assert list(written) == names
    for name in names:
        expected = REPORTS[name](tables, PARAMS)
        csv, sheet = written[name][:2]
        assert rows(display_types(spark.read.parquet(sheet))) == rows(display_types(expected))
        text = spark.read.option("header", True).schema(display_types(expected).schema).csv(csv)
        assert rows(text) == rows(display_types(expected))
    assert len(written["key_account_trend"]) == 3


def test_reports_are_computed_once_and_keep_decimals(spark, tables, tmp_path, monkeypatch):
    ran = spark.sparkContext.accumulator(0)

    def counted(tables, params):
        frame = tables.customers().limit(1).selectExpr("'a' as customer", "cast(12345678901234567.89 as decimal(38,2)) as money")
        return frame.rdd.map(lambda row: (ran.add(1), row)[1]).toDF(frame.schema)

    monkeypatch.setitem(REPORTS, "key_account_trend", counted)
    monkeypatch.setitem(ROW_ORDER, "key_account_trend", ("-money",))
    sheet = run_review(spark, tables, PARAMS, str(tmp_path), ["key_account_trend"])["key_account_trend"][1]
    assert ran.value == 1
    assert spark.read.parquet(sheet).first().money == Decimal("12345678901234567.89")


def test_written_rows_are_in_display_order(spark, tables, tmp_path):
    names = ["monthly_kpis_mom_diff", "weight_charges_by_zone", "return_shipments_by_zone", "top_dest_revenue"]
    written = run_review(spark, tables, PARAMS, str(tmp_path), names)
    for name in names:
        files = sorted(Path(written[name][0]).glob("*.csv"))
        lines = [line for f in files for line in csv.DictReader(f.open())]
        if name.startswith("top"):
            key = [-float(r["a_cur"]) for r in lines]
        else:
            key = [(r.get("month_start", ""), int(r["ord"])) for r in lines]
        assert key == sorted(key) and len(lines) > 4, name


def test_two_reviews_in_one_session_do_not_mix(spark, tables, tmp_path):
    june, may = PARAMS, replace(PARAMS, cur=date(2000, 5, 1))
    first = run_review(spark, tables, may, str(tmp_path / "a"), ["mom_history_build", "monthly_kpis"])
    only_may = ShipmentTables.of(
        **{n: tables.frame(n) for n in NAMES if n != "salesreport"},
        salesreport=tables.frame("salesreport").where("normal_cn_date between '2000-05-01' and '2000-05-31'"),
    )
    second = run_review(spark, only_may, june, str(tmp_path / "b"), ["mom_history_build"])
    months = spark.read.parquet(second["mom_history_build"][1]).select("month_start").distinct().collect()
    assert [r.month_start for r in months] == [date(2000, 5, 1)]
    assert spark.read.parquet(first["mom_history_build"][1]).count() == tables.history().count()


def test_history_is_staged_for_the_months_asked_for(spark, tables, tmp_path):
    asked = []

    class Watched(StagedTables):
        def shipments(self, start=None, end=None):
            asked.append((start, end))
            return super().shipments(start, end)

    staged = Watched(spark, tables, str(tmp_path))
    REPORTS["top_dest_shipments"](staged, PARAMS)
    assert not (tmp_path / "mom_history").exists()
    asked.clear()
    got = staged.history(date(2000, 5, 1), date(2000, 6, 1))
    assert set(asked) == {(date(2000, 5, 1), date(2000, 6, 30))}
    assert rows(got) == rows(tables.history(date(2000, 5, 1), date(2000, 6, 1)))
    asked.clear()
    wider = staged.history(date(2000, 3, 1), date(2000, 6, 1))
    assert set(asked) == {(date(2000, 3, 1), date(2000, 4, 30))}
    assert rows(wider) == rows(tables.history(date(2000, 3, 1), date(2000, 6, 1)))
    asked.clear()
    staged.history(date(2000, 4, 1), date(2000, 5, 1))
    assert not asked


def test_a_review_scans_the_shipments_once_for_each_staged_table(spark, tables, tmp_path):
    """Five account reports, two zone tables, two return tables: one staged table each."""
    built = []
    staged = StagedTables(spark, tables, str(tmp_path))
    share = staged.shared
    staged.shared = lambda name, build: share(name, lambda: (built.append(name), build())[1])
    for name in (
        "account_lifecycle", "approved_accounts_by_sp", "sp_list", "weight_charges_by_zone", "revenue_by_zone_cod",
        "top_dest_returns", "top_dest_return_weight", "key_account_trend", "key_account_group_trend", "top_dest_rps", "top_dest_wps",
    ):
        assert rows(REPORTS[name](staged, PARAMS)) == rows(REPORTS[name](tables, PARAMS)), name
    assert len(built) == len(set(built)) == 5


def test_parameters_of_one_report(spark, tmp_path):
    path = tmp_path / "params.json"
    path.write_text(
        '{"cur": "2000-06-01", "n_months": 6, "reports": {"top_customers": {"n_months": 2}, '
        '"accounts_lost_by_sp": {"account_first": "1995-01-01", "account_last": "1995-03-31"}}}'
    )
    params = load_params(spark, str(path))
    assert params.for_report("top_customers").window == (date(2000, 5, 1), date(2000, 6, 1))
    assert params.for_report("customer_metrics").window == params.window == (date(2000, 1, 1), date(2000, 6, 1))
    assert params.for_report("accounts_lost_by_sp").account_range == (date(1995, 1, 1), date(1995, 3, 31))
    assert params.for_report("new_active_by_sp").account_range == params.account_range
    path.write_text('{"cur": "2000-06-01", "nmonths": 6}')
    with pytest.raises(ValueError):
        load_params(spark, str(path))


def test_refresh_empties_a_month_without_shipments(spark, tables, tmp_path):
    folder = str(tmp_path)
    write_table(tables.history(date(2000, 4, 1), date(2000, 6, 1)), folder, "mom_history")
    fewer = ShipmentTables.of(
        salesreport=tables.frame("salesreport").where("month(normal_cn_date) <> 4"),
        returnreport=tables.frame("returnreport"), crf=tables.frame("crf"),
    )
    refresh_history(fewer, folder, date(2000, 4, 1), date(2000, 5, 1))
    months = read_table(spark, folder, "mom_history").select("month_start").distinct().collect()
    assert sorted(r.month_start for r in months) == [date(2000, 5, 1), date(2000, 6, 1)]


class Database:
    """Stands in for spark.read.jdbc: the rows of each query's WHERE clause, from frames."""

    def __init__(self, spark, frames):
        self.frames, self.queries = frames, {}
        self.conf, self.spark = spark.conf, spark

    @property
    def read(self):
        return self

    def jdbc(self, url, name, predicates=None, properties=None):
        self.queries[name] = predicates
        frame = self.frames[name]
        if predicates is None:
            return frame
        parts = [frame.where(p) for p in predicates]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionAll(part)
        return out


def test_a_database_loses_no_rows(spark, tables):
    late = tables.frame("returnreport").withColumn("normal_cn_date", F.add_months("normal_cn_date", 2))
    frames = {n: tables.frame(n) for n in NAMES} | {"returnreport": late, "mom_history": tables.history().drop("month_start")}
    database = Database(spark, frames)
    stored = jdbc_tables(database, "jdbc:x", FIRST, LAST, with_history=False, account_bounds=["C-2", "C-5"])
    plain = ShipmentTables.of(**{n: frames[n] for n in NAMES})
    for name in ("monthly_returns", "top_dest_returns", "approved_accounts_by_sp", "sp_list", "mom_history_build"):
        assert rows(display_types(REPORTS[name](stored, PARAMS))) == rows(display_types(REPORTS[name](plain, PARAMS))), name
    assert stored.history().where("ret_ship > 0").count() > 0
    assert len(database.queries["salesreport"]) == 5 and len(database.queries["crf"]) == 3
    kept = jdbc_tables(database, "jdbc:x", FIRST, LAST)
    assert rows(kept.history().select(*MOM_HISTORY.names)) == rows(tables.history().select(*MOM_HISTORY.names))
    assert len(database.queries["mom_history"]) == 4


class Collated(Database):
    """A database that compares text without regard to case, and answers queries in place of a table."""

    def jdbc(self, url, name, predicates=None, properties=None):
        if name.startswith("("):
            for table, frame in self.frames.items():
                frame.createOrReplaceTempView(table)
            return self.spark.sql(f"SELECT * FROM {name}")
        return super().jdbc(url, name, predicates, properties)


@pytest.mark.parametrize("how", [{"account_bounds": ["C", "b", "a9"]}, {"account_bounds": ["a", "A"]}, {"account_parts": 3}, {"account_parts": 50}, {}])
def test_accounts_are_read_once_in_any_order_of_the_database(spark, how):
    names = [f"{letter}{k}" for letter in "aAbBcC" for k in range(4)] + ["a0", "it's", "\u00e9", None, None]
    plain = customers(spark, *[{"acc_no": n, "cust_name": f"{i}"} for i, n in enumerate(names)])
    database = Collated(spark, {"crf": plain.withColumn("acc_no", F.collate("acc_no", "UTF8_LCASE"))})
    read = jdbc_tables(database, "jdbc:x", FIRST, LAST, **how).customers()
    assert sorted(r.cust_name for r in read.collect()) == sorted(str(i) for i in range(len(names)))
    assert read.schema["acc_no"].dataType.simpleString() == "string"
    clauses = database.queries["crf"]
    assert (clauses is None) == (not how)
    if how.get("account_parts") == 3:
        parts = [database.frames["crf"].where(c).count() for c in clauses]
        assert len(parts) == 3 and max(parts) <= 14


def test_no_account_to_cut_at(spark):
    database = Collated(spark, {"crf": customers(spark, {"acc_no": None})})
    assert jdbc_tables(database, "jdbc:x", FIRST, LAST, account_parts=4).customers().count() == 1


def test_wider_stored_types_are_read_and_checked(spark, tmp_path):
    frame = shipments(spark, {"weight": 3}, {"weight": 4})
    frame.withColumn("weight", F.col("weight").cast("decimal(18,2)")).write.parquet(f"{tmp_path}/a/salesreport")
    assert sorted(r.weight for r in read_table(spark, f"{tmp_path}/a", "salesreport").collect()) == [3, 4]
    frame.withColumn("weight", F.lit(1_000_000).cast("decimal(18,2)")).write.parquet(f"{tmp_path}/b/salesreport")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        read_table(spark, f"{tmp_path}/b", "salesreport").collect()


def test_absent_charges_stay_unknown(spark):
    bare = shipments(spark, {}).drop("normal_fsc", "normal_other_charges")
    tables = ShipmentTables.of(salesreport=conform(bare, "salesreport"), returnreport=returns(spark), crf=customers(spark))
    row = tables.history().first()
    assert (row.n_fsc, row.n_oth_chgs, row.n_rev) == (None, None, 12)


def test_names_lose_all_white_space(spark):
    frame = shipments(spark, {"sp_name": "\t ann b\u00a0\n"}, {"sp_name": "Ann B"}, {"sp_name": None})
    names = {r.sp_name for r in ShipmentTables.of(salesreport=frame).sales_people().collect()}
    assert names == {"ANN B", None}


def test_one_folder_per_customer(spark, tables, tmp_path):
    report = REPORTS["key_account_trend"](tables, PARAMS)
    path = write_per_customer(report, str(tmp_path), "key_account_trend")
    customers = {r.customer for r in report.select("customer").distinct().collect()}
    assert all(len(list(d.glob("*.csv"))) == 1 for d in Path(path).glob("customer=*"))
    back = spark.read.option("header", True).csv(path)
    assert {r.customer for r in back.select("customer").distinct().collect()} == customers
    assert back.count() == report.count()


def test_shared_intermediates_are_written_once(spark, tables, tmp_path):
    staged = StagedTables(spark, tables, str(tmp_path))
    first = staged.shared("cube", lambda: tables.customers())
    again = staged.shared("cube", lambda: pytest.fail("built twice"))
    assert first is again
