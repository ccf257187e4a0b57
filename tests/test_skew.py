"""A third of all rows under one account, sales person, destination and returned shipment."""

from __future__ import annotations

from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelscope.operators.returns import returned_by_destination
from parcelscope.plans import destinations, sales_people, zones
from parcelscope.plans.history import build_history
from parcelscope.schema import CRF, RETURNREPORT, SALESREPORT

N = 3000
DAY = date(2024, 2, 9)
MONTHS = {"prev": date(2024, 1, 1), "cur": date(2024, 2, 1)}


def typed(frame, schema, **rules):
    columns = [f"cast({rules.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}" for f in schema]
    return frame.selectExpr(*columns)


@pytest.fixture(scope="module")
def hot(spark):
    """Join sides must shuffle, and adaptive execution must see the hot partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    pick = "if(id % 3 = 0, 'HOT', concat('{0}', id % {1}))"
    sent = typed(
        spark.range(N),
        SALESREPORT,
        normal_cn="concat('n', id)",
        normal_cn_date=f"date'{DAY}'",
        acc_no=pick.format("A", 40),
        sp_name=pick.format("S", 7),
        origin="'X'",
        dest=pick.format("D", 9),
        master_dest=pick.format("D", 9),
        dest_zone="element_at(array('A', 'B', 'C'), cast(id % 3 + 1 as int))",
        weight="1 + id % 5",
        normal_weight_charges="id % 11",
        normal_revenue="id % 13",
        cod="id % 2",
    ).withColumn("month_start", F.trunc("normal_cn_date", "month"))
    back = typed(
        spark.range(N // 2),
        RETURNREPORT,
        normal_cn="concat('n', if(id % 3 = 0, 3, id))",
        normal_cn_date=f"date'{DAY}'",
        return_cn="concat('r', id)",
        return_weight_charges="id % 7",
    )
    names = typed(sent.select("acc_no").distinct(), CRF, acc_no="acc_no", cust_name="acc_no")
    yield sent, back, names
    for key, value in before.items():
        spark.conf.set(key, value)


def returned_numbers():
    return [3 if i % 3 == 0 else i for i in range(N // 2)]


def destination(i):
    return "HOT" if i % 3 == 0 else f"D{i % 9}"


def test_hot_returned_shipment(hot):
    sent, back, _ = hot
    returned = returned_by_destination(sent, back, list(MONTHS.values()))
    table = destinations.top_by_return_weight(returned, MONTHS, 100).collect()
    expected = Counter()
    for i in returned_numbers():
        expected[destination(i)] += 1 + i % 5
    assert {r.master_dest: r.cur for r in table} == dict(expected)


def test_hot_matrix_counts_every_joined_row(hot):
    sent, back, _ = hot
    row = zones.dest_day_sums(sent, back).where("master_dest = 'HOT'").first()
    times = Counter(returned_numbers())
    hot_ids = [i for i in range(N) if i % 3 == 0]
    assert row.n_s_za == sum(max(times[i], 1) for i in hot_ids)
    assert row.r_s_za == sum(times[i] for i in hot_ids)
    assert row.n_rev_za == sum(max(times[i], 1) * (i % 13) for i in hot_ids)


def test_hot_sales_person(hot):
    history = build_history(*hot)
    rows = sales_people.sp_customer_scorecard(sales_people.sp_customer_sums(history)).collect()
    accounts = {("HOT" if i % 3 == 0 else f"A{i % 40}", "HOT" if i % 3 == 0 else f"S{i % 7}") for i in range(N)}
    assert {(r.acc_no, r.sp_name) for r in rows} == accounts
    whole = sum(i % 13 for i in range(N))
    shares = sum(r.n_rev for r in rows)
    assert shares == whole
    (top,) = [r for r in rows if r.sp_name == "HOT"]
    assert top.revenue_share_sp == 100.0
    assert top.shipment == N // 3
