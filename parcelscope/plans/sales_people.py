"""Sales-person scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelscope.functions.numbers import percent, ratio, rounded, total
from parcelscope.operators.shares import sum_of_all

SUMMED = {
    "shipment": "shipments",
    "n_s_wc": "n_s_wc",
    "n_s_za": "n_s_za",
    "n_s_zb": "n_s_zb",
    "n_s_zc": "n_s_zc",
    "kg_0_0_5": "kg_0_0_5",
    "kg_0_5_1_0": "kg_0_5_1_0",
    "n_wght": "n_wght",
    "n_rev": "n_rev",
    "ret_ship_chrg": "r_s_chrg",
    "r_s_za": "r_s_za",
    "ret_ship": "ret_ship",
    "ret_revenue": "ret_revenue",
}
SHOWN_SUMS = ("shipment", "n_wght", "n_rev", "ret_ship_chrg", "r_s_za", "ret_ship", "ret_revenue")
KEYS = ("sp_name", "cust_name", "acc_no")


def _keyed(history: DataFrame) -> DataFrame:
    return history.where(
        F.col("sp_name").isNotNull() & F.col("cust_name").isNotNull() & F.col("acc_no").isNotNull()
    )


def sp_customer_sums(history: DataFrame) -> DataFrame:
    """One row per sales person, customer and account of the month in `history`: the base of the scorecard and its wholes."""
    return _keyed(history).groupBy(*KEYS).agg(*[total(source).alias(name) for name, source in SUMMED.items()])


def sp_customer_scorecard(sums: DataFrame) -> DataFrame:
    """The scorecard of `sp_customer_sums`.

    Wholes are summed from these rows, per sales person with map-side partial sums and joined back, so a
    sales person with most of the accounts never has to fit one task; the whole of all is a sum over the
    few sales persons. The wholes read every column of the sums, though they show two: so both sides of the
    join are one shuffle to Spark, which it runs once where the sums are not stored.
    """
    every = F.max(F.hash(*[F.col(c) for c in sums.columns]))
    wholes = sums.groupBy("sp_name").agg(total("n_rev").alias("sp_rev"), total("n_s_za").alias("sp_za"), every.alias("every"))
    wholes = wholes.where("every is not null").select("sp_name", "sp_rev", sum_of_all("sp_rev").alias("all_rev"), sum_of_all("sp_za").alias("all_za"))
    light = F.col("kg_0_0_5") + F.col("kg_0_5_1_0")
    derived = {
        "wc_pct": rounded(percent("n_s_wc", "shipment")),
        "za_pct": rounded(percent("n_s_za", "shipment")),
        "zb_pct": rounded(percent("n_s_zb", "shipment")),
        "zc_pct": rounded(percent("n_s_zc", "shipment")),
        "kg_0_1_pct": rounded(percent(light, "shipment")),
        "revenue_share_total": rounded(percent("n_rev", "all_rev")),
        "revenue_share_sp": rounded(percent("n_rev", "sp_rev")),
        "rps": rounded(ratio("n_rev", "shipment"), 0),
        "rpw": rounded(ratio("n_rev", "n_wght"), 0),
        "ws": rounded(ratio("n_wght", "shipment"), 0),
        "zone_a_return_pct": percent("r_s_za", "all_za"),
        "return_ratio": rounded(percent("ret_ship", "shipment")),
    }
    filled = [F.coalesce(c, F.lit(0.0)).alias(name) for name, c in derived.items()]
    return sums.join(wholes, "sp_name").select(*KEYS, *SHOWN_SUMS, *filled)


def sp_totals(history: DataFrame) -> DataFrame:
    light = total("kg_0_0_5") + total("kg_0_5_1_0")
    shipments = total("shipments")
    return (
        history.where(F.col("sp_name").isNotNull())
        .groupBy("sp_name")
        .agg(
            rounded(percent(total("n_s_wc"), shipments)).alias("wc_pct"),
            rounded(percent(total("n_s_za"), shipments)).alias("za_pct"),
            rounded(percent(light, shipments)).alias("kg_0_1_pct"),
        )
    )
