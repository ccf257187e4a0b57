"""Zone tables: previous and current month side by side, share of the month, change."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from parcelscope.functions.dates import month_of
from parcelscope.functions.numbers import (
    nonzero_or_null,
    percent,
    ratio,
    rounded,
    total,
    total_when,
)
from parcelscope.functions.shipments import zone_slot, zone_type
from parcelscope.operators.reshape import at_month, to_long, with_order
from parcelscope.operators.returns import with_returns
from parcelscope.operators.shares import whole_of
from parcelscope.schema import ZONE_SLOTS


# Row labels of the zone tables and the history columns they add up.
RETURN_SHIPMENT_ROWS = {
    "Return_Shipments": "ret_ship",
    "WC": "r_s_wc",
    "Zone_A": "r_s_za",
    "Zone_B": "r_s_zb",
    "Zone_C": "r_s_zc",
    "With_charges": "r_s_chrg",
    "With_no_charges": "r_s_nchrg",
}
WEIGHT_ROWS = {
    "Normal_Weight": "n_wght",
    "WC": "n_wght_wc",
    "Zone_A": "n_wght_za",
    "Zone_B": "n_wght_zb",
    "Zone_C": "n_wght_zc",
}
RETURN_WEIGHT_ROWS = {
    "Return_Weight": "r_wght",
    "WC": "r_wght_wc",
    "Zone_A": "r_wght_za",
    "Zone_B": "r_wght_zb",
    "Zone_C": "r_wght_zc",
    "Wght_chrgs": "r_wght_chrg",
    "Wght_no_chrgs": "r_wght_nchrg",
}
# Zone types in display order; any other comes behind them, then the total lines.
ZONE_ORDER = ("WC", "A", "B", "C")
RETURN_REVENUE_ROWS = {"WC": "r_rev_wc", "Zone_A": "r_rev_za", "Zone_B": "r_rev_zb", "Zone_C": "r_rev_zc"}


def _compared(
    by_month: DataFrame,
    measures: list[str],
    base: Column,
    months: Mapping[str, date],
    round_values: bool,
) -> DataFrame:
    """Measures as rows, months as columns; each share divides by its own month's base."""
    long = to_long(
        by_month.withColumn("base", base), ["month_start", "base"], measures, "description"
    )
    value = rounded(F.col("value")) if round_values else F.col("value")
    share = rounded(percent("value", "base"))
    cells = [at_month(value, month).alias(role) for role, month in months.items()]
    shares = [at_month(share, months[role]).alias(f"{role}_pct") for role in ("prev", "cur")]
    change = F.col("cur") - F.col("prev")
    table = long.groupBy("description").agg(*cells, *shares)
    table = table.withColumn("inc_dec", rounded(change, 0) if round_values else change)
    return with_order(table, measures, "description")


def _zone_sums(history: DataFrame, months: Mapping[str, date], columns: Mapping[str, str]) -> DataFrame:
    wanted = history.where(F.col("month_start").isin(*months.values()))
    sums = [total(column).alias(label) for label, column in columns.items()]
    return wanted.groupBy("month_start").agg(*sums)


def days_in(working_days: Mapping[date, int], month: Column | str = "month_start") -> Column:
    """Working days of the month; null where they are not known."""
    days = F.lit(None).cast("int")
    for start, count in working_days.items():
        days = F.when(F.col(month) == F.lit(start), F.lit(count)).otherwise(days)
    return days


def return_shipments_by_zone(history: DataFrame, months: Mapping[str, date]) -> DataFrame:
    sums = _zone_sums(history, months, RETURN_SHIPMENT_ROWS | {"shipments": "shipments"})
    return _compared(sums, list(RETURN_SHIPMENT_ROWS), F.col("shipments"), months, round_values=False)


def weight_by_zone(
    history: DataFrame, months: Mapping[str, date], working_days: Mapping[date, int]
) -> DataFrame:
    daily = F.coalesce(rounded(ratio("Normal_Weight", days_in(working_days))), F.lit(0.0))
    sums = _zone_sums(history, months, WEIGHT_ROWS).withColumn("per_working_day", daily)
    measures = [*WEIGHT_ROWS, "per_working_day"]
    return _compared(sums, measures, F.col("Normal_Weight"), months, round_values=True)


def return_weight_by_zone(history: DataFrame, months: Mapping[str, date]) -> DataFrame:
    sums = _zone_sums(history, months, RETURN_WEIGHT_ROWS)
    return _compared(sums, list(RETURN_WEIGHT_ROWS), F.col("Return_Weight"), months, round_values=True)


def zone_month_sums(shipments: DataFrame, months: Mapping[str, date]) -> DataFrame:
    """What both zone reports over shipments read: sums per zone type, `<name>_prev` and `<name>_cur`."""
    revenue = F.col("normal_revenue")
    measures = {
        "charges": F.col("normal_weight_charges"),
        "revenue": revenue,
        "cod": F.when(nonzero_or_null("cod"), revenue),
        "ncod": F.when(F.col("cod") == 0, revenue),
    }
    sums = [
        total_when(F.col("month_start") == F.lit(month), measure).alias(f"{name}_{role}")
        for name, measure in measures.items()
        for role, month in months.items()
    ]
    wanted = shipments.where(F.col("month_start").isin(*months.values()))
    return wanted.groupBy(zone_type().alias("dest_zone_type")).agg(*sums)


def _zone_rows(sums: DataFrame) -> DataFrame:
    """The sums of each zone type and over all of them; the roll-up doubles only these few rows."""
    names = [c for c in sums.columns if c != "dest_zone_type"]
    return (
        sums.rollup("dest_zone_type")
        .agg(
            F.grouping("dest_zone_type").cast("boolean").alias("is_total"),
            *[total(name).cast("double").alias(name) for name in names],
        )
        .where(F.col("is_total") | F.col("dest_zone_type").isNotNull())
    )


def _line(
    ord: Column | int, label: Column, measure: str, source: str, divide_by: Mapping[str, Column] | None = None
) -> Column:
    """One output row taken from the columns `<source>_prev` and `<source>_cur`."""
    place = F.lit(ord) if isinstance(ord, int) else ord
    cells = []
    for role in ("prev", "cur"):
        cell = F.col(f"{source}_{role}")
        cells.append((ratio(cell, divide_by[role]) if divide_by else cell).alias(role))
    named = [label.alias("dest_zone_type"), F.lit(measure).alias("measure")]
    return F.struct(place.cast("int").alias("ord"), *named, *cells)


def _zone_place() -> Column:
    known = F.array_position(F.array(*map(F.lit, ZONE_ORDER)), F.col("dest_zone_type"))
    return F.when(known > 0, known).otherwise(len(ZONE_ORDER) + 1)


def _zone_report(
    zone_rows: DataFrame, zone_line: Column, total_lines: list[Column], base: str
) -> DataFrame:
    lines = F.when(F.col("is_total"), F.array(*total_lines)).otherwise(F.array(zone_line))
    based = zone_rows.select(
        whole_of(f"{base}_prev").alias("base_prev"),
        whole_of(f"{base}_cur").alias("base_cur"),
        F.explode(lines).alias("line"),
    )
    return based.select(
        "line.ord",
        "line.dest_zone_type",
        "line.measure",
        rounded(F.col("line.prev")).alias("prev"),
        rounded(F.col("line.cur")).alias("cur"),
        rounded(percent("line.prev", "base_prev")).alias("prev_pct"),
        rounded(percent("line.cur", "base_cur")).alias("cur_pct"),
    ).withColumn("inc_dec", rounded(F.col("cur") - F.col("prev"), 0))


def _days(months: Mapping[str, date], working_days: Mapping[date, int]) -> dict[str, Column]:
    return {role: F.lit(working_days.get(month)).cast("int") for role, month in months.items()}


def weight_charges_by_zone(
    sums: DataFrame, months: Mapping[str, date], working_days: Mapping[date, int]
) -> DataFrame:
    rows = _zone_rows(sums.select("dest_zone_type", "charges_prev", "charges_cur"))
    measure = "normal_weight_charges"
    total_lines = [
        _line(6, F.lit("Normal Weight Charges"), measure, "charges"),
        _line(7, F.lit("Daily Normal Charge"), measure, "charges", _days(months, working_days)),
    ]
    zone_line = _line(_zone_place(), F.col("dest_zone_type"), measure, "charges")
    return _zone_report(rows, zone_line, total_lines, "charges").drop("measure")


def revenue_by_zone_cod(
    sums: DataFrame, months: Mapping[str, date], working_days: Mapping[date, int]
) -> DataFrame:
    """Zone rows hold weight charges, all other rows revenue; `measure` names which."""
    rows = _zone_rows(sums)
    measure = "normal_revenue"
    total_lines = [
        _line(6, F.lit("normal_revenue"), measure, "revenue"),
        _line(7, F.lit("Total Revenue - COD"), measure, "cod"),
        _line(8, F.lit("Total Revenue - NCOD"), measure, "ncod"),
        _line(9, F.lit("Daily Normal Charge"), measure, "revenue", _days(months, working_days)),
    ]
    zone_line = _line(_zone_place(), F.col("dest_zone_type"), "normal_weight_charges", "charges")
    return _zone_report(rows, zone_line, total_lines, "revenue")


def _matrix_measures() -> dict[str, Column]:
    """A shipment with several returns counts once per joined row, or per numbered return."""
    joined = F.greatest(F.col("return_rows"), F.lit(1))
    returned = F.col("returned_rows")
    return {
        "n_s": joined,
        "r_s": returned,
        "n_wght": F.col("weight") * joined,
        "r_wght": F.col("weight") * returned,
        "n_wght_chgs": F.col("normal_weight_charges") * joined,
        "n_rev": F.col("normal_revenue") * joined,
        "r_rev": F.col("return_charges"),
    }


def dest_day_sums(shipments: DataFrame, returns: DataFrame) -> DataFrame:
    """Seven measures by zone for every destination and day, over shipments left join returns."""
    sums = [
        total_when(F.col("slot") == slot, measure).alias(f"{name}_{slot}")
        for name, measure in _matrix_measures().items()
        for slot in ZONE_SLOTS
    ]
    return (
        with_returns(shipments, returns)
        .withColumn("slot", zone_slot())
        .groupBy("master_dest", "normal_cn_date")
        .agg(*sums)
    )


def dest_day_zone_matrix(sums: DataFrame) -> DataFrame:
    return sums.orderBy(F.desc("n_s_wc"))


def return_revenue_by_zone(matrix: DataFrame, months: Mapping[str, date]) -> DataFrame:
    dated = matrix.withColumn("month_start", month_of("normal_cn_date"))
    whole = sum((F.col(label) for label in list(RETURN_REVENUE_ROWS)[1:]), F.col("WC"))
    sums = _zone_sums(dated, months, RETURN_REVENUE_ROWS).withColumn("Total_Ret_Revenue", whole)
    measures = ["Total_Ret_Revenue", *RETURN_REVENUE_ROWS]
    return _compared(sums, measures, F.col("Total_Ret_Revenue"), months, round_values=False)
