"""Top destinations of the previous and the current month.

A destination outside a month's top n shows zero for that month, whatever it shipped.
All reports but the return ones read one cube: a single aggregation of the shipments to
(month, destination, zone, zone type), with map-side partial sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from parcelscope.functions.dates import month_of
from parcelscope.functions.numbers import percent, ratio, rounded, total
from parcelscope.functions.shipments import zone_type
from parcelscope.operators.reshape import at_month, side_by_side
from parcelscope.operators.shares import whole_of
from parcelscope.operators.topn import top_k, top_n_per_group

ZONES = ("A", "B", "C")
ZONE_TYPES = ("A", "B", "C", "WC")


def destination_cube(shipments: DataFrame) -> DataFrame:
    keyed = shipments.where(F.col("master_dest").isNotNull() & F.col("month_start").isNotNull())
    return (
        keyed.withColumn("zone_type", zone_type())
        .groupBy("month_start", "master_dest", "dest_zone", "zone_type")
        .agg(
            F.count("normal_cn").alias("shipments"),
            total("weight").alias("weight"),
            total("normal_weight_charges").alias("charges"),
            total("normal_revenue").alias("revenue"),
        )
    )


def _zone_columns(measure: str, zone_column: str, zones: Sequence[str]) -> list[Column]:
    """Sum per zone; null where the destination has no row in the zone."""
    return [
        F.sum(F.when(F.col(zone_column) == zone, F.col(measure))).alias(zone.lower())
        for zone in zones
    ]


def top_by_shipments(cube: DataFrame, months: Mapping[str, date], n: int) -> DataFrame:
    per_dest = cube.groupBy("month_start", "master_dest").agg(
        *_zone_columns("shipments", "dest_zone", ZONES), total("shipments").alias("shipments")
    )
    best = top_n_per_group(per_dest, ["month_start"], "shipments", n, ["master_dest"])
    shown = side_by_side(best, ["master_dest"], ["a", "b", "c", "shipments"], months, fill=0)
    return shown.orderBy(F.desc("shipments_cur"), "master_dest")


def top_by_zone_a(cube: DataFrame, measure: str, months: Mapping[str, date], n: int) -> DataFrame:
    per_dest = cube.groupBy("month_start", "master_dest").agg(
        *_zone_columns(measure, "dest_zone", ZONES)
    )
    best = top_n_per_group(per_dest, ["month_start"], "a", n, ["master_dest"])
    shown = side_by_side(best, ["master_dest"], ["a", "b", "c"], months, fill=0)
    return shown.orderBy(F.desc("a_cur"), "master_dest")


def top_by_zone_a_with_share(
    cube: DataFrame, measure: str, months: Mapping[str, date], n: int
) -> DataFrame:
    """As top_by_zone_a, with the three zones added up and their share of the month.

    GROUPING SETS over the cube yields the month's whole as one more row; it ranks in a
    group of its own and leaves the table once the shares are taken.
    """
    sets = [["month_start", "master_dest"], ["month_start"]]
    per_dest = (
        cube.groupingSets(sets, "month_start", "master_dest")
        .agg(
            F.grouping("master_dest").cast("boolean").alias("is_total"),
            *_zone_columns(measure, "dest_zone", ZONES),
            total(measure).alias("whole"),
        )
        .withColumn("rank_by", F.when(F.col("is_total"), F.col("whole")).otherwise(F.col("a")))
    )
    best = top_n_per_group(per_dest, ["month_start", "is_total"], "rank_by", n, ["master_dest"])
    shown = side_by_side(
        best, ["master_dest", "is_total"], ["a", "b", "c", "whole"], months, fill=0
    )
    roles = list(months)
    added = {
        f"total_{r}": rounded(F.col(f"a_{r}") + F.col(f"b_{r}") + F.col(f"c_{r}")) for r in roles
    }
    shares = {
        f"pct_{r}": rounded(percent(f"total_{r}", F.col(f"month_{r}"))) for r in roles
    }
    wholes = {f"month_{r}": whole_of(f"whole_{r}") for r in roles}
    table = shown.withColumns(added).withColumns(wholes).withColumns(shares)
    kept = ["master_dest"]
    kept += [f"{zone}_{r}" for zone in ("a", "b", "c") for r in roles]
    kept += [f"total_{r}" for r in roles] + [f"pct_{r}" for r in roles]
    return table.where(~F.col("is_total")).select(*kept).orderBy(F.desc("a_cur"), "master_dest")


def top_by_ratio(
    cube: DataFrame, name: str, over: str, under: str, months: Mapping[str, date], n: int
) -> DataFrame:
    """Ratio per zone type and overall; the overall ratio ranks. Rounding comes last."""
    by_zone = [
        ratio(
            F.sum(F.when(F.col("zone_type") == zone, F.col(over))),
            F.sum(F.when(F.col("zone_type") == zone, F.col(under))),
        ).alias(zone.lower())
        for zone in ZONE_TYPES
    ]
    per_dest = cube.groupBy("month_start", "master_dest").agg(
        *by_zone, ratio(F.sum(over), F.sum(under)).alias(name)
    )
    best = top_n_per_group(per_dest, ["month_start"], name, n, ["master_dest"])
    values = [zone.lower() for zone in ZONE_TYPES] + [name]
    shown = side_by_side(best, ["master_dest"], values, months, fill=0.0)
    cells = [c for c in shown.columns if c != "master_dest"]
    return (
        shown.orderBy(F.desc(f"{name}_cur"), "master_dest")
        .select("master_dest", *[rounded(F.col(c)).alias(c) for c in cells])
    )


def _top_returned(
    returned: DataFrame, measure: str, base: str, months: Mapping[str, date], n: int
) -> DataFrame:
    """Top destinations of returned shipments; shares divide by the month's own returns.

    `returned` is operators.returns.returned_by_destination: a row per destination and month, which
    holds the wholes as well.
    """
    per_dest = returned.where(F.col("master_dest").isNotNull() & (F.col("return_rows") > 0))
    best = top_n_per_group(per_dest.drop(base), ["month_start"], measure, n, ["master_dest"])
    bases = returned.groupBy("month_start").agg(total(base).alias("base"))
    ranked = best.join(bases, "month_start", "left").withColumn(
        "share", rounded(percent(measure, "base"))
    )
    value = F.col(measure).cast("double")
    cells = [F.coalesce(at_month(value, m), F.lit(0.0)).alias(r) for r, m in months.items()]
    shares = [
        F.coalesce(at_month("share", m), F.lit(0.0)).alias(f"{r}_pct") for r, m in months.items()
    ]
    return (
        ranked.groupBy("master_dest")
        .agg(*cells, *shares)
        .withColumn("inc_dec", F.col("cur") - F.col("prev"))
    )


def top_by_returns(returned: DataFrame, months: Mapping[str, date], n: int) -> DataFrame:
    return _top_returned(returned, "returned", "ret_ship", months, n).orderBy("master_dest")


def top_by_return_weight(returned: DataFrame, months: Mapping[str, date], n: int) -> DataFrame:
    table = _top_returned(returned, "weight", "r_wght", months, n)
    cells = [c for c in table.columns if c != "master_dest"]
    return table.select(
        "master_dest", *[rounded(F.col(c)).alias(c) for c in cells]
    ).orderBy(F.desc("cur"), "master_dest")


def top_by_return_revenue(matrix: DataFrame, months: Mapping[str, date], n: int) -> DataFrame:
    """Best n of the current month overall; a month without shipments stays empty."""
    slots = ("r_rev_wc", "r_rev_za", "r_rev_zb", "r_rev_zc")
    revenue = sum((F.col(s) for s in slots[1:]), F.col(slots[0]))
    per_month = (
        matrix.where(F.col("master_dest").isNotNull())
        .withColumn("month_start", month_of("normal_cn_date"))
        .groupBy("master_dest", "month_start")
        .agg(total(revenue).alias("revenue"))
    )
    cells = [at_month("revenue", month).alias(role) for role, month in months.items()]
    return top_k(
        per_month.groupBy("master_dest").agg(*cells),
        [F.desc_nulls_last("cur"), F.asc("master_dest")],
        n,
    )
