"""Shipments with their returns.

A shipment may be returned more than once. The returns are summed to one row per
shipment before the join, so the join never multiplies rows; reports whose meaning is
the multiplied join weigh each shipment by its number of return rows instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from parcelscope.functions.numbers import total, total_when


def returns_per_shipment(returns: DataFrame) -> DataFrame:
    """return_rows, those with a return number, and the charges on the latter."""
    numbered = F.col("return_cn") != ""
    return (
        returns.where(F.col("normal_cn").isNotNull())
        .groupBy("normal_cn")
        .agg(
            F.count(F.lit(1)).cast("int").alias("return_rows"),
            F.count_if(numbered).cast("int").alias("returned_rows"),
            total_when(numbered, "return_weight_charges").alias("return_charges"),
        )
    )


def with_returns(shipments: DataFrame, returns: DataFrame) -> DataFrame:
    """Every shipment once, return columns zero where it was never returned."""
    per_shipment = returns_per_shipment(returns)
    return shipments.join(per_shipment, "normal_cn", "left").na.fill(
        0, ["return_rows", "returned_rows", "return_charges"]
    )


def returned_by_destination(
    shipments: DataFrame, returns: DataFrame, months: Sequence[date]
) -> DataFrame:
    """Inner join summed to (month, destination), for the listed months; destinations may be null.

    By the month of the return row: return_rows; returned, those with a number; weight, the
    shipment's once per return row. By the month of the shipment, each shipment with a numbered
    return once: ret_ship and r_wght, the parts of the wholes that shares divide by.
    The months stay columns across the join, so one shuffle on the shipment number serves
    both the sum per shipment and the join.
    """
    per_month, sums, lines = [], [], []
    numbered = F.col("numbered") > 0
    for i, month in enumerate(months):
        dated = F.trunc("normal_cn_date", "month") == F.lit(month)
        shipped = numbered & (F.col("month_start") == F.lit(month))
        per_month += [
            F.count(F.when(dated, F.col("return_cn"))).alias(f"returned_{i}"),
            F.count_if(dated).cast("int").alias(f"rows_{i}"),
        ]
        sums += [
            total(f"returned_{i}").alias(f"returned_{i}"),
            total(f"rows_{i}").alias(f"rows_{i}"),
            total(F.col("weight") * F.col(f"rows_{i}")).alias(f"weight_{i}"),
            F.count_if(shipped).alias(f"ret_ship_{i}"),
            total_when(shipped, "weight").alias(f"r_wght_{i}"),
        ]
        lines.append(
            F.struct(
                F.lit(month).alias("month_start"),
                F.col(f"rows_{i}").alias("return_rows"),
                F.col(f"returned_{i}").alias("returned"),
                F.col(f"weight_{i}").alias("weight"),
                F.col(f"ret_ship_{i}").alias("ret_ship"),
                F.col(f"r_wght_{i}").alias("r_wght"),
            )
        )
    per_shipment = (
        returns.where(F.col("normal_cn").isNotNull())
        .groupBy("normal_cn")
        .agg(*per_month, F.count_if(F.col("return_cn") != "").cast("int").alias("numbered"))
    )
    return (
        shipments.select("normal_cn", "master_dest", "weight", "month_start")
        .join(per_shipment, "normal_cn")
        .groupBy("master_dest")
        .agg(*sums)
        .select("master_dest", F.inline(F.array(*lines)))
    )
