"""Hand-made rows of the logical tables; unnamed columns take a neutral value."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from parcelscope.schema import ACC_FORM, CRF, MOM_HISTORY, RETURNREPORT, SALESREPORT


def _value(kind: T.DataType, value):
    if value is None:
        return None
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    return value


def frame(spark: SparkSession, schema: T.StructType, rows: list[dict], neutral: dict) -> DataFrame:
    filled = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        merged = neutral | row
        filled.append(tuple(_value(f.dataType, merged.get(f.name)) for f in schema))
    return spark.createDataFrame(filled, schema)


def history(spark: SparkSession, *rows: dict) -> DataFrame:
    neutral = {f.name: 0 for f in MOM_HISTORY if not isinstance(f.dataType, T.StringType)}
    neutral |= {
        "acc_no": "A",
        "cust_name": "a",
        "cust_type": "COD",
        "sp_name": "S",
        "month_start": date(2024, 1, 1),
        "month": "x",
    }
    return frame(spark, MOM_HISTORY, list(rows), neutral)


def shipments(spark: SparkSession, *rows: dict) -> DataFrame:
    """salesreport rows, numbered n1, n2, ... unless given."""
    neutral = {
        "normal_cn_date": date(2024, 1, 5),
        "acc_no": "A",
        "sp_name": "S",
        "origin": "X",
        "dest": "Y",
        "master_origin": "X",
        "master_dest": "Y",
        "dest_zone": "A",
        "weight": 1,
        "weight_band": "0.5-1.0",
        "normal_weight_charges": 10,
        "normal_fsc": 1,
        "normal_other_charges": 1,
        "normal_revenue": 12,
        "cod": 0,
    }
    numbered = [{"normal_cn": f"n{i}"} | row for i, row in enumerate(rows, start=1)]
    return frame(spark, SALESREPORT, numbered, neutral)


def returns(spark: SparkSession, *rows: dict) -> DataFrame:
    neutral = {"normal_cn_date": date(2024, 1, 5), "return_cn": "r", "return_weight_charges": 5}
    return frame(spark, RETURNREPORT, list(rows), neutral)


def forms(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, ACC_FORM, list(rows), {})


def customers(spark: SparkSession, *rows: dict) -> DataFrame:
    return frame(spark, CRF, list(rows), {"cust_name": "a", "cust_type": "COD"})
