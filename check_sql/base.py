"""The logical tables as DuckDB CTEs over the raw tables (rules in FIXTURES.md)."""

from __future__ import annotations

FORM_BALANCE = 100  # FIXTURES.md, section of the account forms


def double(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def div(over: str, under: str) -> str:
    return f"({double(over)} / nullif({double(under)}, 0))"


def pct(part: str, whole: str) -> str:
    return f"({div(part, whole)} * 100)"


def r(value: str, digits: int = 2) -> str:
    return f"round_even({double(value)}, {digits})"


SHIPMENTS = """ship AS (
  SELECT *, normal_weight_charges + normal_fsc + normal_other_charges AS normal_revenue,
         CAST(date_trunc('month', normal_cn_date) AS DATE) AS month_start
  FROM (
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS normal_cn,
      CAST(l_shipdate AS DATE) AS normal_cn_date,
      'C-' || o_custkey AS acc_no,
      c_mktsegment AS sp_name,
      cn.n_name AS origin, sn.n_name AS dest, sn.n_name AS master_dest,
      CASE (c_nationkey + s_nationkey) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS dest_zone,
      CAST(l_quantity / 10 AS DECIMAL(18,2)) AS weight,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS normal_weight_charges,
      CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS normal_fsc,
      CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS normal_other_charges,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
           THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS cod
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation cn ON c_nationkey = cn.n_nationkey
    JOIN nation sn ON s_nationkey = sn.n_nationkey))"""

RETURNS = """ret AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS normal_cn,
    CAST(l_shipdate AS DATE) AS normal_cn_date,
    'R-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS return_cn,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END
      AS return_weight_charges
  FROM lineitem WHERE l_returnflag = 'R')"""

CUSTOMERS = """crf AS (
  SELECT 'C-' || c_custkey AS acc_no, c_name AS cust_name,
    CASE WHEN c_acctbal >= 0 THEN 'COD' ELSE 'CASH' END AS cust_type
  FROM customer)"""

FORMS = f"""forms AS (
  SELECT acc_no, first_cn, creation_date,
    creation_date + CAST(k % 20 AS INTEGER) AS finance_approval,
    creation_date + CAST(k % 25 AS INTEGER) AS second_approval
  FROM (
    SELECT c_custkey AS k, 'C-' || c_custkey AS acc_no,
      CAST(min(l_shipdate) AS DATE) AS first_cn,
      CAST(min(l_shipdate) AS DATE) - CAST(c_custkey % 45 AS INTEGER) AS creation_date
    FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
    WHERE c_acctbal >= {FORM_BALANCE}
    GROUP BY c_custkey))"""

_ZONES = {
    "wc": "origin = dest",
    "za": "origin <> dest AND dest_zone = 'A'",
    "zb": "origin <> dest AND dest_zone = 'B'",
    "zc": "origin <> dest AND dest_zone = 'C'",
}


def _zoned(prefix: str, value: str, extra: str = "TRUE") -> str:
    return ", ".join(
        f"coalesce(sum({value}) FILTER ({condition} AND {extra}), 0) AS {prefix}_{slot}"
        for slot, condition in _ZONES.items()
    )


_BACK = "return_cn IS NOT NULL"
MOM = f"""mom AS (
  SELECT s.acc_no, c.cust_name, c.cust_type, s.sp_name, s.month_start,
    count(*) AS shipments, {_zoned('n_s', '1')},
    count(return_cn) AS ret_ship, {_zoned('r_s', '1', _BACK)},
    count(*) FILTER ({_BACK} AND return_weight_charges <> 0) AS r_s_chrg,
    count(*) FILTER ({_BACK} AND return_weight_charges = 0) AS r_s_nchrg,
    count(*) FILTER (weight <= 0.5) AS kg_0_0_5,
    count(*) FILTER (weight > 0.5 AND weight <= 1.0) AS kg_0_5_1_0,
    sum(weight) AS n_wght, {_zoned('n_wght', 'weight')},
    coalesce(sum(weight) FILTER ({_BACK}), 0) AS r_wght, {_zoned('r_wght', 'weight', _BACK)},
    coalesce(sum(weight) FILTER ({_BACK} AND return_weight_charges <> 0), 0) AS r_wght_chrg,
    coalesce(sum(weight) FILTER ({_BACK} AND return_weight_charges = 0), 0) AS r_wght_nchrg,
    sum(normal_weight_charges) AS n_wght_chgs, sum(normal_fsc) AS n_fsc,
    sum(normal_other_charges) AS n_oth_chgs, sum(normal_revenue) AS n_rev, sum(cod) AS cod,
    {_zoned('n_rev', 'normal_revenue')},
    coalesce(sum(return_weight_charges), 0) AS ret_revenue
  FROM ship s LEFT JOIN (
    SELECT normal_cn, max(return_cn) AS return_cn, sum(return_weight_charges) AS return_weight_charges
    FROM ret WHERE return_cn <> '' GROUP BY normal_cn) q ON q.normal_cn = s.normal_cn
  LEFT JOIN crf c ON c.acc_no = s.acc_no
  GROUP BY s.acc_no, c.cust_name, c.cust_type, s.sp_name, s.month_start)"""
