"""What the account-by-month roll-up moves between tasks: narrow shipments, never its many sums."""

from __future__ import annotations

import re
from collections import Counter
from contextlib import contextmanager
from datetime import date

from pyspark.sql import functions as F

from parcelscope.plans.history import build_history
from parcelscope.schema import CRF, RETURNREPORT, SALESREPORT


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def typed(frame, schema, **rules):
    return frame.selectExpr(*[f"cast({rules.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}" for f in schema])


def tables(spark, n, account):
    sent = typed(
        spark.range(n), SALESREPORT, normal_cn="concat('n', id)", normal_cn_date="date'2024-02-09'", acc_no=account, sp_name="concat('S', id % 3)",
        origin="'X'", dest="'Y'", dest_zone="'A'", weight="1", normal_weight_charges="id % 11", normal_revenue="id % 13", cod="0",
    ).withColumn("month_start", F.trunc("normal_cn_date", "month"))
    back = typed(spark.range(n // 2), RETURNREPORT, normal_cn="concat('n', id)", normal_cn_date="date'2024-02-09'", return_cn="'r'", return_weight_charges="1")
    return sent, back, typed(sent.select("acc_no").distinct(), CRF, acc_no="acc_no", cust_name="concat('of ', acc_no)")


def test_sums_are_made_where_they_stay(spark):
    """No exchange lies above a sum of the roll-up, and money moves as longs; broadcasting is off as for large sides."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        plan = build_history(*tables(spark, 30, "concat('A', id % 4)"))._jdf.queryExecution().executedPlan().toString().splitlines()
    exchanges = [i for i, line in enumerate(plan) if "Exchange hash" in line]
    sums = [i for i, line in enumerate(plan) if "Aggregate(keys=[acc_no" in line and "sum(" in line]
    assert sums and exchanges and max(sums) < min(exchanges)
    keys = Counter(re.search(r"hashpartitioning\((.*?)#", plan[i]).group(1) for i in exchanges)
    assert keys["acc_no"] <= 3 and not any("sp_name" in plan[i] for i in exchanges)


def test_a_hot_account_is_split(spark):
    small = {f"spark.sql.adaptive.{k}": v for k, v in {
        "skewJoin.skewedPartitionThresholdInBytes": "2KB", "skewJoin.skewedPartitionFactor": "1.5", "advisoryPartitionSizeInBytes": "2KB",
        "coalescePartitions.enabled": "false",
    }.items()}
    n = 3000
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", **small):
        frame = build_history(*tables(spark, n, "if(id % 3 < 2, 'HOT', concat('A', id % 40))"))
        rows = frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    shipped, returned = Counter(), Counter()
    for i in range(n):
        key = ("HOT" if i % 3 < 2 else f"A{i % 40}", f"S{i % 3}")
        shipped[key] += 1
        returned[key] += i < n // 2
    assert {(r.acc_no, r.sp_name): r.shipments for r in rows} == shipped and len(rows) == len(shipped)
    assert all(r.ret_ship == returned[r.acc_no, r.sp_name] and r.cust_name == f"of {r.acc_no}" for r in rows)
    assert {r.month_start for r in rows} == {date(2024, 2, 1)}
