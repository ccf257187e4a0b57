"""The five logical tables a review reads."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DATE = T.StringType(), T.LongType(), T.DateType()
# The weight of one parcel needs no more than eight digits, and Spark adds up decimals of
# up to eight digits as longs. Sums of an account and month have room for eight digits more.
MONEY, WEIGHT, CHARGE = T.DecimalType(20, 4), T.DecimalType(8, 2), T.DecimalType(18, 2)
SUM_MONEY, SUM_WEIGHT = T.DecimalType(28, 4), T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SALESREPORT = _struct(
    normal_cn=STRING,
    normal_cn_date=DATE,
    acc_no=STRING,
    sp_name=STRING,
    origin=STRING,
    dest=STRING,
    master_origin=STRING,
    master_dest=STRING,
    dest_zone=STRING,
    weight=WEIGHT,
    weight_band=STRING,
    normal_weight_charges=CHARGE,
    normal_fsc=MONEY,
    normal_other_charges=MONEY,
    normal_revenue=MONEY,
    cod=CHARGE,
)

RETURNREPORT = _struct(
    normal_cn=STRING,
    normal_cn_date=DATE,
    return_cn=STRING,
    return_weight_charges=CHARGE,
)

ACC_FORM = _struct(
    acc_no=STRING,
    creation_date=DATE,
    finance_approval=DATE,
    second_approval=DATE,
    first_cn=DATE,
)

CRF = _struct(acc_no=STRING, cust_name=STRING, cust_type=STRING)

ZONE_SLOTS = ("wc", "za", "zb", "zc")
HISTORY_KEYS = ("acc_no", "cust_name", "cust_type", "sp_name", "month_start")
HISTORY_COUNTS = (
    "shipments",
    *(f"n_s_{z}" for z in ZONE_SLOTS),
    "ret_ship",
    *(f"r_s_{z}" for z in ZONE_SLOTS),
    "r_s_chrg",
    "r_s_nchrg",
    "kg_0_0_5",
    "kg_0_5_1_0",
)
HISTORY_WEIGHTS = (
    "n_wght",
    *(f"n_wght_{z}" for z in ZONE_SLOTS),
    "r_wght",
    *(f"r_wght_{z}" for z in ZONE_SLOTS),
    "r_wght_chrg",
    "r_wght_nchrg",
)
HISTORY_MONEY = (
    "n_wght_chgs",
    "n_fsc",
    "n_oth_chgs",
    "n_rev",
    "cod",
    *(f"n_rev_{z}" for z in ZONE_SLOTS),
    "ret_revenue",
)

MOM_HISTORY = _struct(
    acc_no=STRING,
    cust_name=STRING,
    cust_type=STRING,
    sp_name=STRING,
    month_start=DATE,
    month=STRING,
    **{name: LONG for name in HISTORY_COUNTS},
    **{name: SUM_WEIGHT for name in HISTORY_WEIGHTS},
    **{name: SUM_MONEY for name in HISTORY_MONEY},
)
