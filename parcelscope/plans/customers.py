"""Customer bands, leaderboards, key accounts and the flat extract."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelscope.functions.numbers import (
    nonzero_or_null,
    percent,
    ratio,
    rounded,
    total,
)
from parcelscope.functions.shipments import left_closed_band
from parcelscope.functions.text import percent_text, thousands
from parcelscope.operators.reshape import to_long, with_order
from parcelscope.operators.shares import sum_of_all
from parcelscope.operators.topn import top_k, top_n_per_group


def _bands(spark: SparkSession, edges: Sequence[int]) -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("band_no"), F.lit(f"{low}-{high}").alias("band"))
        for i, (low, high) in enumerate(zip(edges, edges[1:]), start=1)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def shipment_bands(history: DataFrame, edges: Sequence[int]) -> DataFrame:
    """Account-months by shipment band; rows outside all bands stay in every base.

    rps and ws divide by the number of account rows, rpw by weight.
    """
    per_band = (
        history.withColumn("band_no", left_closed_band(F.col("shipments"), tuple(edges)))
        .groupBy("band_no")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("acc_no").alias("customers"),
            total("shipments").alias("shipments"),
            total("n_wght").alias("weight"),
            total("n_rev").alias("revenue"),
        )
    )
    measures = ("customers", "shipments", "weight", "revenue")
    based = per_band.withColumns({f"all_{m}": sum_of_all(m) for m in measures})
    joined = _bands(history.sparkSession, edges).join(based, "band_no", "left")

    def shown(measure: str) -> list[Column]:
        text = percent_text(F.coalesce(percent(measure, f"all_{measure}"), F.lit(0.0)))
        return [F.coalesce(measure, F.lit(0)).alias(measure), text.alias(f"{measure}_pct")]

    per_row = {"rps": ratio("revenue", "rows"), "ws": ratio("weight", "rows")}
    per_weight = F.when(F.col("weight") > 0, ratio("revenue", "weight"))
    return joined.orderBy("band_no").select(
        "band",
        *[column for m in measures for column in shown(m)],
        F.coalesce(per_row["rps"], F.lit(0.0)).alias("rps"),
        F.coalesce(per_weight, F.lit(0.0)).alias("rpw"),
        F.coalesce(per_row["ws"], F.lit(0.0)).alias("ws"),
    )


def with_customer_metrics(history: DataFrame, whole: Column) -> DataFrame:
    """Ratios of every account-month; the revenue share is of `whole`, the revenue of the window."""
    return history.withColumns(
        {
            "rps": rounded(ratio("n_rev", "shipments")),
            "rpw": rounded(ratio("n_rev", "n_wght")),
            "ws": rounded(ratio("n_wght", "shipments")),
            "return_ratio": percent("ret_ship", "shipments"),
            "return_ratio_wc_za": percent(F.col("r_s_wc") + F.col("r_s_za"), "shipments"),
            "wc_za": percent(F.col("n_s_wc") + F.col("n_s_za"), "shipments"),
            "kg_0_1": percent(F.col("kg_0_0_5") + F.col("kg_0_5_1_0"), "shipments"),
            "revenue_pct": percent("n_rev", whole),
            "return_tariff": rounded(ratio("ret_revenue", "ret_ship"), 0),
            "zb": percent("n_s_zb", "shipments"),
        }
    )


METRIC_COLUMNS = (
    "rps",
    "rpw",
    "ws",
    "return_ratio",
    "return_ratio_wc_za",
    "wc_za",
    "kg_0_1",
    "revenue_pct",
    "return_tariff",
    "zb",
)


def customer_metrics(history: DataFrame, whole: Column) -> DataFrame:
    return with_customer_metrics(history, whole).select("acc_no", "month_start", *METRIC_COLUMNS)


# Leaderboard, the column that ranks it, and its direction.
LEADERBOARDS = (
    ("Top5Shipments", "shipments", 1),
    ("Top5Revenue", "n_rev", 1),
    ("Top5RPS", "rps", 1),
    ("Top5RPW", "rpw", 1),
    ("Top5LowestRPS", "rps", -1),
    ("Top5LowestRPW", "rpw", -1),
    ("Top5HighestReturnRatio", "return_ratio", 1),
    ("Top5ZBShipments", "zb", 1),
)


BOARD_TIES = ("acc_no", "sp_name", "month_start")


def board_rows(
    history: DataFrame, whole: Column, min_shipments: int, min_weight_per_shipment: float
) -> DataFrame:
    """Account-months that may stand on a leaderboard, with their metrics; an account may appear once per month."""
    return with_customer_metrics(history, whole).where(
        (F.col("shipments") >= min_shipments) & (F.col("ws") >= min_weight_per_shipment)
    )


def top_customers(eligible: DataFrame, n: int) -> DataFrame:
    """Eight leaderboards from one pass over `board_rows`, for rows that are not stored."""
    entries = [
        F.struct(
            F.lit(board).alias("leaderboard"),
            (F.col(column).cast("double") * sign).alias("score"),
            F.col("zb" if column == "zb" else "wc_za").alias("zone_share"),
        )
        for board, column, sign in LEADERBOARDS
    ]
    expanded = eligible.select("*", F.inline(F.array(*entries)))
    return _boards(top_n_per_group(expanded, ["leaderboard"], "score", n, BOARD_TIES))


def top_customers_by_heaps(stored: DataFrame, n: int) -> DataFrame:
    """The same from stored `board_rows`: a heap of n rows per task and board, no row expanded or sorted.

    Each board reads the stored rows once; what meets in one task is eight times n rows.
    """
    boards = []
    for board, column, sign in LEADERBOARDS:
        scored = stored.withColumns(
            {
                "leaderboard": F.lit(board),
                "score": F.col(column).cast("double") * sign,
                "zone_share": F.col("zb" if column == "zb" else "wc_za"),
            }
        ).where(F.col("score").isNotNull())
        boards.append(top_k(scored, [F.desc("score"), *[F.asc(t) for t in BOARD_TIES]], n))
    best = boards[0]
    for rows in boards[1:]:
        best = best.unionByName(rows)
    return _boards(top_n_per_group(best, ["leaderboard"], "score", n, BOARD_TIES))


def _boards(ranked: DataFrame) -> DataFrame:
    """The columns of a leaderboard. `zone_share` is the share within city plus zone A, on the last board that of zone B."""
    return ranked.select(
        "leaderboard",
        "rank",
        F.col("cust_name").alias("customer"),
        F.col("sp_name").alias("sp"),
        thousands(F.col("shipments"), 0).alias("total_shipments"),
        percent_text(F.col("zone_share")).alias("zone_share"),
        percent_text(F.col("kg_0_1")).alias("kg_0_1"),
        thousands(F.col("n_wght")).alias("weight"),
        thousands(F.col("n_rev")).alias("revenue"),
        percent_text(F.col("revenue_pct")).alias("revenue_pct"),
        "rps",
        "rpw",
        "ws",
        "return_tariff",
        F.col("ret_ship").alias("return_shipments"),
        percent_text(F.col("return_ratio")).alias("return_ratio"),
        percent_text(F.col("return_ratio_wc_za")).alias("return_ratio_wc_za"),
    )


# Metrics of the key-account tables, in display order.
TREND_METRICS = ("Total_Shipments", "Total_Weight", "Total_Revenue", "RPS", "RPW", "WS")


def key_account_months(
    shipments: DataFrame, customers: DataFrame, accounts: Sequence[str], start: date, end: date
) -> DataFrame:
    """Account by month for the named accounts, with the customer name.

    `shipments` holds start to end; months whose first day precedes `start` are left out.
    """
    rolled = (
        shipments.where(F.col("acc_no").isin(*accounts))
        .where(F.col("month_start").between(F.lit(start), F.lit(end)))
        .groupBy("acc_no", "month_start")
        .agg(
            F.count("normal_cn").alias("shipments"),
            total("weight").alias("weight"),
            total("normal_revenue").alias("revenue"),
        )
    )
    names = customers.where(F.col("acc_no").isin(*accounts)).select("acc_no", "cust_name")
    return rolled.join(names, "acc_no")


def _trend(account_months: DataFrame, keys: Sequence[str]) -> DataFrame:
    sums = account_months.groupBy(*keys, "month_start").agg(
        total("shipments").alias("Total_Shipments"),
        total("weight").alias("Total_Weight"),
        total("revenue").alias("Total_Revenue"),
    )
    wide = sums.withColumns(
        {
            "RPS": rounded(ratio("Total_Revenue", "Total_Shipments")),
            "RPW": rounded(ratio("Total_Revenue", "Total_Weight")),
            "WS": rounded(ratio("Total_Weight", "Total_Shipments")),
        }
    )
    long = with_order(to_long(wide, [*keys, "month_start"], TREND_METRICS), TREND_METRICS)
    return long.select(
        *keys, "month_start", "metric", "ord", F.coalesce("value", F.lit(0.0)).alias("value")
    )


def key_account_trend(account_months: DataFrame, names: Sequence[str]) -> DataFrame:
    named = account_months.where(F.col("cust_name").isin(*names))
    return _trend(named.withColumnRenamed("cust_name", "customer"), ["customer"])


def key_account_group_trend(account_months: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named customers merged into one."""
    return _trend(account_months.where(F.col("cust_name").isin(*names)), [])


def all_data_extract(history: DataFrame) -> DataFrame:
    """A Normal line per account-month and, where something came back, a Return line."""

    def line(kind: str, **cells: Column) -> Column:
        named = [cell.alias(name) for name, cell in cells.items()]
        return F.struct(*named, F.lit(kind).alias("type"))

    def money(column: Column | str) -> Column:
        return (F.col(column) if isinstance(column, str) else column).cast("decimal(30,4)")

    none = F.lit(0)
    normal = line(
        "Normal",
        shipments=F.col("shipments"),
        weight=money("n_wght"),
        weight_charges=money("n_wght_chgs"),
        other_charges=money("n_oth_chgs"),
        revenue=money("n_rev"),
        shipment_zone_a=F.col("n_s_za"),
        fsc=money("n_fsc"),
        revenue_without_fsc=money(F.col("n_rev") - F.col("n_fsc")),
    )
    returned = line(
        "Return",
        shipments=F.col("ret_ship"),
        weight=money("r_wght"),
        weight_charges=money("r_wght_chrg"),
        other_charges=money(none),
        revenue=money("ret_revenue"),
        shipment_zone_a=F.col("r_s_za"),
        fsc=money(none),
        revenue_without_fsc=money("ret_revenue"),
    )
    lines = F.when(nonzero_or_null("ret_ship"), F.array(normal, returned)).otherwise(F.array(normal))
    return history.select(
        "month_start", "cust_type", "acc_no", "sp_name", F.inline(lines)
    )
