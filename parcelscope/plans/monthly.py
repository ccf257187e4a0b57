"""Month series: KPIs, returns, their change, and the ratio breakdowns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelscope.functions.dates import label_short
from parcelscope.functions.numbers import nonzero_or_null, percent, ratio, rounded, total, total_when
from parcelscope.functions.text import accounting, plain, thousands
from parcelscope.operators.reshape import month_on_month, to_long, with_order
from parcelscope.schema import ZONE_SLOTS

# Metric names of the two KPI tables, in display order.
KPI_METRICS = (
    "Active_Accounts",
    "Normal_Shipments",
    "Normal_Weight",
    "Weight_Charges",
    "fuel_Surcharge",
    "Cash_handling",
    "Total_normal_rev",
    "RPS",
    "RPW",
    "WPS",
)
RETURN_METRICS = (
    "active_accounts",
    "Return_Shipment",
    "Shipment_Ret_ration",
    "Return_Weight",
    "Weight_ret_ratio",
    "return_revenue",
    "RPS",
    "RPW",
)
# Metrics a card prints with separators; the others print as they are.
KPI_THOUSANDS = KPI_METRICS[:7]
RETURN_THOUSANDS = ("active_accounts", "Return_Shipment", "Return_Weight", "return_revenue")


def by_month(history: DataFrame, **measures: Column) -> DataFrame:
    dated = history.where(F.col("month_start").isNotNull())
    return dated.groupBy("month_start").agg(*[c.alias(name) for name, c in measures.items()])


def _kpi_sums() -> dict[str, Column]:
    return {
        "accounts": F.count("acc_no"),
        "shipments": total("shipments"),
        "weight": total("n_wght"),
        "weight_charges": total("n_wght_chgs"),
        "fsc": total("n_fsc"),
        "other_charges": total("n_oth_chgs"),
        "revenue": total("n_rev"),
    }


def _return_sums() -> dict[str, Column]:
    """Sums over account-months with returns, beside those over all of them."""
    returned = nonzero_or_null("ret_ship")
    return {
        "shipments": total("shipments"),
        "weight": total("n_wght"),
        "ret_rows": F.count_if(returned),
        "ret_accounts": F.count(F.when(returned, F.col("acc_no"))),
        "ret_shipments": total_when(returned, "ret_ship"),
        "ret_weight": total_when(returned, "r_wght"),
        "ret_revenue": total_when(returned, "ret_revenue"),
    }


def _kpi_values() -> dict[str, Column]:
    values = (
        F.col("accounts"),
        F.col("shipments"),
        F.col("weight"),
        F.col("weight_charges"),
        F.col("fsc"),
        F.col("other_charges"),
        F.col("revenue"),
        rounded(ratio("revenue", "shipments")),
        rounded(ratio("revenue", "weight")),
        rounded(ratio("weight", "shipments")),
    )
    return dict(zip(KPI_METRICS, values))


def _return_values() -> dict[str, Column]:
    """The ratios divide by all shipments of the same month."""
    values = (
        F.col("ret_accounts"),
        F.col("ret_shipments"),
        rounded(percent("ret_shipments", "shipments")),
        F.col("ret_weight"),
        rounded(percent("ret_weight", "weight")),
        F.col("ret_revenue"),
        rounded(ratio("ret_revenue", "ret_shipments")),
        rounded(ratio("ret_revenue", "ret_weight")),
    )
    return dict(zip(RETURN_METRICS, values))


def _long_from(sums: DataFrame, values: dict[str, Column]) -> DataFrame:
    wide = sums.select("month_start", *[c.alias(name) for name, c in values.items()])
    long = with_order(to_long(wide, ["month_start"], list(values)), list(values))
    return long.select("month_start", "metric", "ord", "value")


def monthly_kpis(history: DataFrame) -> DataFrame:
    return _long_from(by_month(history, **_kpi_sums()), _kpi_values())


def monthly_returns(history: DataFrame) -> DataFrame:
    """Months with returns only."""
    sums = by_month(history, **_return_sums()).where(F.col("ret_rows") > 0)
    return _long_from(sums, _return_values())


def month_diff(long: DataFrame) -> DataFrame:
    return month_on_month(long).select("month_start", "metric", "ord", "diff")


def month_change(long: DataFrame) -> DataFrame:
    """Fraction, not percent."""
    return month_on_month(long).select("month_start", "metric", "ord", "pct_chng")


def kpi_cards(history: DataFrame) -> DataFrame:
    """Text of the KPI and returns slides for every month that has one before it.

    One pass over the history feeds both slides.
    """

    def lines(slide: str, values: dict[str, Column]) -> list[Column]:
        return [
            F.struct(
                F.lit(slide).alias("slide"),
                F.lit(metric).alias("metric"),
                F.lit(ord).alias("ord"),
                value.cast("double").alias("value"),
            )
            for ord, (metric, value) in enumerate(values.items(), start=1)
        ]

    kpis = F.array(*lines("kpi", _kpi_values()))
    returns = F.array(*lines("returns", _return_values()))
    sums = by_month(history, **(_kpi_sums() | _return_sums()))
    long = sums.select(
        "month_start",
        F.inline(F.when(F.col("ret_rows") > 0, F.concat(kpis, returns)).otherwise(kpis)),
    )

    on_kpi = F.col("slide") == "kpi"
    separated = F.when(on_kpi, F.col("metric").isin(*KPI_THOUSANDS)).otherwise(
        F.col("metric").isin(*RETURN_THOUSANDS)
    )
    diff = F.when(on_kpi & separated, accounting(F.col("diff"), 0)).otherwise(
        accounting(F.col("diff"), 2)
    )
    change = F.col("pct_chng") * 100
    change_text = F.when(on_kpi, accounting(change, 3)).otherwise(accounting(change, 1))
    value = F.when(separated, thousands(F.col("value"))).otherwise(plain(F.col("value")))
    before = F.concat(label_short("prev_month"), F.lit(": "), plain(F.col("prev_value")))
    return month_on_month(long, ["slide", "metric"]).select(
        "month_start",
        "slide",
        "metric",
        "ord",
        value.alias("value_text"),
        before.alias("prev_text"),
        F.concat(F.lit("Diff : "), diff).alias("diff_text"),
        F.concat(F.lit(", "), change_text, F.lit("%")).alias("pct_text"),
    )


def month_series(history: DataFrame, name: str, measure: Column) -> DataFrame:
    """One value per month, chronological, with the month label."""
    series = by_month(history, **{name: measure})
    labelled = series.select("month_start", label_short("month_start").alias("month"), name)
    return labelled.orderBy("month_start")


def sum_series(history: DataFrame, column: str) -> DataFrame:
    return month_series(history, column, total(column))


def monthly_rps(history: DataFrame) -> DataFrame:
    return month_series(history, "rps", rounded(ratio(total("n_rev"), total("shipments"))))


def monthly_rpw(history: DataFrame) -> DataFrame:
    return month_series(history, "rpw", rounded(ratio(total("n_rev"), total("n_wght"))))


def monthly_wps(history: DataFrame) -> DataFrame:
    return month_series(history, "wps", rounded(ratio(total("n_wght"), total("shipments"))))


def _by_slot(prefix: str, over: str, under: str) -> dict[str, Column]:
    return {
        f"{prefix}_{slot}": rounded(ratio(total(f"{over}_{slot}"), total(f"{under}_{slot}")))
        for slot in ZONE_SLOTS
    }


def _without(component: str, under: str) -> Column:
    return rounded(ratio(total("n_rev") - total(component), total(under)))


def rps_breakdown(history: DataFrame) -> DataFrame:
    cod, ncod = nonzero_or_null("cod"), F.col("cod") == 0

    def paid(condition: Column) -> Column:
        return rounded(ratio(total_when(condition, "n_rev"), total_when(condition, "shipments")))

    return by_month(
        history,
        rps=rounded(ratio(total("n_rev"), total("shipments"))),
        rps_ex_fsc=_without("n_fsc", "shipments"),
        rps_ex_chc=_without("n_oth_chgs", "shipments"),
        rps_cod=paid(cod),
        rps_ncod=paid(ncod),
        **_by_slot("rps", "n_rev", "n_s"),
    ).orderBy("month_start")


def rpw_breakdown(history: DataFrame) -> DataFrame:
    return by_month(
        history,
        rpw=rounded(ratio(total("n_rev"), total("n_wght"))),
        rpw_ex_fsc=_without("n_fsc", "n_wght"),
        rpw_ex_chc=_without("n_oth_chgs", "n_wght"),
        **_by_slot("rpw", "n_rev", "n_wght"),
    ).orderBy("month_start")


def wps_breakdown(history: DataFrame) -> DataFrame:
    return by_month(
        history,
        ws=rounded(ratio(total("n_wght"), total("shipments"))),
        **_by_slot("ws", "n_wght", "n_s"),
    ).orderBy("month_start")
