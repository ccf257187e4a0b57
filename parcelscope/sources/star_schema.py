"""Logical tables derived from an order/line-item star schema (rules in FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from parcelscope.functions.shipments import weight_class
from parcelscope.schema import ACC_FORM, CRF, RETURNREPORT, SALESREPORT
from parcelscope.sources.tables import ShipmentTables

# The columns the derivations read; declared, so that no file is opened to plan a query.
RAW_SCHEMAS = {
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string",
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey long, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
}

# Accounts whose balance lies below this never handed in a form.
FORM_BALANCE = 100
HAS_FORM = f"c_acctbal >= {FORM_BALANCE}"

Reader = Callable[[str], DataFrame]


SHIPMENT_NUMBER = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
CHARGES = "cast(l_extendedprice as decimal(18,2))"


def _conform(frame: DataFrame, schema: StructType, **rules: str) -> DataFrame:
    """One column per field of the schema, computed by its rule and cast to its type."""
    return frame.selectExpr(
        *[
            f"cast({rules.get(f.name, f.name)} as {f.dataType.simpleString()}) as {f.name}"
            for f in schema
        ]
    )


def derive_salesreport(read: Reader) -> DataFrame:
    nation = read("nation")
    customer = read("customer").join(nation, F.expr("c_nationkey = n_nationkey"))
    supplier = read("supplier").join(nation, F.expr("s_nationkey = n_nationkey"))
    ordered = read("orders").join(
        customer.selectExpr("c_custkey", "c_mktsegment", "c_nationkey", "n_name as city_from"),
        F.expr("o_custkey = c_custkey"),
    )
    # The supplier first, while the rows are narrow: the wider rows that have their order move no more.
    sent = read("lineitem").join(
        supplier.selectExpr("s_suppkey", "s_nationkey", "n_name as city_to"),
        F.expr("l_suppkey = s_suppkey"),
    )
    joined = sent.join(ordered, F.expr("l_orderkey = o_orderkey"))
    fsc = f"{CHARGES} * cast(l_tax as decimal(4,2))"
    other = f"{CHARGES} * cast(l_discount as decimal(4,2))"
    weighed = joined.selectExpr("*", "cast(l_quantity / 10 as decimal(18,2)) as weight")
    return _conform(
        weighed.withColumn("weight_band", weight_class()),
        SALESREPORT,
        normal_cn=SHIPMENT_NUMBER,
        normal_cn_date="l_shipdate",
        acc_no="concat('C-', o_custkey)",
        sp_name="c_mktsegment",
        origin="city_from",
        dest="city_to",
        master_origin="city_from",
        master_dest="city_to",
        dest_zone="element_at(array('A', 'B', 'C'), (c_nationkey + s_nationkey) % 3 + 1)",
        normal_weight_charges=CHARGES,
        normal_fsc=fsc,
        normal_other_charges=other,
        normal_revenue=f"{CHARGES} + {fsc} + {other}",
        cod="case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_totalprice else 0 end",
    )


def derive_returnreport(read: Reader) -> DataFrame:
    return _conform(
        read("lineitem").where("l_returnflag = 'R'"),
        RETURNREPORT,
        normal_cn=SHIPMENT_NUMBER,
        normal_cn_date="l_shipdate",
        return_cn=f"concat('R-', {SHIPMENT_NUMBER})",
        return_weight_charges=f"case when l_linestatus = 'F' then {CHARGES} else 0 end",
    )


def derive_acc_form(read: Reader, has_form: str = HAS_FORM) -> DataFrame:
    """One form per shipping account; some accounts have none (`has_form` is false)."""
    forms = read("customer").where(has_form)
    first_ship = (
        read("orders")
        .join(read("lineitem"), F.expr("l_orderkey = o_orderkey"))
        .groupBy("o_custkey")
        .agg(F.expr("cast(min(l_shipdate) as date) as first_cn"))
    )
    created = first_ship.join(forms, F.expr("o_custkey = c_custkey")).selectExpr(
        "*", "date_sub(first_cn, cast(c_custkey % 45 as int)) as creation_date"
    )
    return _conform(
        created,
        ACC_FORM,
        acc_no="concat('C-', c_custkey)",
        finance_approval="date_add(creation_date, cast(c_custkey % 20 as int))",
        second_approval="date_add(creation_date, cast(c_custkey % 25 as int))",
    )


def derive_crf(read: Reader) -> DataFrame:
    return _conform(
        read("customer"),
        CRF,
        acc_no="concat('C-', c_custkey)",
        cust_name="c_name",
        cust_type="case when c_acctbal >= 0 then 'COD' else 'CASH' end",
    )


DERIVATIONS = {
    "salesreport": derive_salesreport,
    "returnreport": derive_returnreport,
    "acc_form": derive_acc_form,
    "crf": derive_crf,
}


def star_schema_tables(spark: SparkSession, folder: str) -> ShipmentTables:
    def read(name: str) -> DataFrame:
        return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")

    return ShipmentTables(lambda name: DERIVATIONS[name](read), returns_dated=True)
