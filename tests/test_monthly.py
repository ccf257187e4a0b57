from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelscope.plans import monthly
from tests.frames import history

# A published six-month sample (FIXTURES.md section 4).
MONTHS = [date(2023, m, 1) for m in range(6, 12)]
SAMPLE = {
    "Active_Accounts": [2012, 1860, 2097, 2142, 2108, 2099],
    "Normal_Shipments": [292127, 297911, 373097, 351551, 345749, 375299],
    "Normal_Weight": [314794.25, 311389.73, 389458.31, 378162.21, 383728.43, 422056.13],
    "Weight_Charges": [
        50445727.24, 50977537.44, 63649440.85, 60704189.21, 60562011.68, 67056960.47,
    ],
    "fuel_Surcharge": [4160564.20, 4256268.88, 5286748.04, 8059524.79, 9035914.20, 9122673.09],
    "Cash_handling": [2024171.74, 2199401.21, 2746505.28, 2394469.03, 2140751.97, 2423027.73],
    "Total_normal_rev": [
        56630463.18, 57433207.45, 71682694.06, 71158182.98, 71738677.81, 78602661.22,
    ],
    "RPS": [193.86, 192.79, 192.13, 202.41, 207.49, 209.44],
    "RPW": [179.90, 184.44, 184.06, 188.17, 186.95, 186.24],
    "WPS": [1.08, 1.05, 1.04, 1.08, 1.11, 1.12],
}
NOV_DIFF = {
    "Active_Accounts": -9.00, "Normal_Shipments": 29550.00, "Normal_Weight": 38327.70,
    "Weight_Charges": 6494948.79, "fuel_Surcharge": 86758.89, "Cash_handling": 282275.76,
    "Total_normal_rev": 6863983.41, "RPS": 1.95, "RPW": -0.71, "WPS": 0.01,
}
NOV_CHANGE = {
    "Active_Accounts": -0.004269, "Normal_Shipments": 0.085467, "Normal_Weight": 0.099882,
    "Weight_Charges": 0.107245, "fuel_Surcharge": 0.009602, "Cash_handling": 0.131858,
    "Total_normal_rev": 0.095680, "RPS": 0.009398, "RPW": -0.003798, "WPS": 0.009009,
}


@pytest.fixture(scope="module")
def sample(spark):
    """One row with the month's sums, and empty account rows up to the month's row count."""
    sums = []
    for i, month in enumerate(MONTHS):
        sums.append(
            {
                "month_start": month,
                "shipments": SAMPLE["Normal_Shipments"][i],
                "n_wght": SAMPLE["Normal_Weight"][i],
                "n_wght_chgs": SAMPLE["Weight_Charges"][i],
                "n_fsc": SAMPLE["fuel_Surcharge"][i],
                "n_oth_chgs": SAMPLE["Cash_handling"][i],
                "n_rev": SAMPLE["Total_normal_rev"][i],
                "ret_ship": SAMPLE["Active_Accounts"][i] - 1,
            }
        )
    first = history(spark, *sums)
    rest = history(spark, *[{"month_start": m} for m in MONTHS]).drop("ret_ship").join(
        first.select("month_start", "ret_ship"), "month_start"
    )
    spread = rest.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("ret_ship")))).drop("_")
    return first.unionByName(spread.select(*first.columns))


def test_golden_values(sample):
    rows = monthly.monthly_kpis(sample).collect()
    assert len(rows) == 60
    for row in rows:
        expected = SAMPLE[row.metric][MONTHS.index(row.month_start)]
        assert row.value == pytest.approx(expected, abs=1e-6), row
        assert row.ord == list(SAMPLE).index(row.metric) + 1


def test_golden_differences(sample):
    kpis = monthly.monthly_kpis(sample)
    diffs = monthly.month_diff(kpis).collect()
    assert len(diffs) == 50
    for row in diffs:
        i = MONTHS.index(row.month_start)
        values = SAMPLE[row.metric]
        assert row.diff == pytest.approx(values[i] - values[i - 1], abs=0.011)
        if i == 5:
            assert row.diff == pytest.approx(NOV_DIFF[row.metric], abs=0.011)


def test_golden_changes(sample):
    changes = monthly.month_change(monthly.monthly_kpis(sample)).collect()
    november = {r.metric: r.pct_chng for r in changes if r.month_start == MONTHS[5]}
    assert november.keys() == NOV_CHANGE.keys()
    for metric, expected in NOV_CHANGE.items():
        assert november[metric] == pytest.approx(expected, abs=6e-5)


def test_card_text(sample):
    cards = {
        (r.slide, r.metric): r
        for r in monthly.kpi_cards(sample).where("month_start = '2023-11-01'").collect()
    }
    accounts = cards["kpi", "Active_Accounts"]
    assert accounts.value_text == "2,099.00"
    assert accounts.prev_text == "Oct-23: 2108.0"
    assert accounts.diff_text == "Diff : (9)"
    assert accounts.pct_text == ", (0.427)%"
    revenue = cards["kpi", "Total_normal_rev"]
    assert revenue.value_text == "78,602,661.22"
    assert revenue.prev_text == "Oct-23: 71738677.81"
    assert revenue.diff_text == "Diff : 6863983"
    rpw = cards["kpi", "RPW"]
    assert (rpw.value_text, rpw.diff_text) == ("186.24", "Diff : (0.71)")


def test_missing_month_is_skipped_not_zero(spark):
    frame = history(
        spark,
        {"month_start": date(2024, 1, 1), "shipments": 4},
        {"month_start": date(2024, 3, 1), "shipments": 6},
    )
    rows = monthly.month_diff(monthly.monthly_kpis(frame)).where("metric = 'Normal_Shipments'")
    assert [(r.month_start, r.diff) for r in rows.collect()] == [(date(2024, 3, 1), 2.0)]


def test_null_month_is_no_group(spark):
    frame = history(spark, {"shipments": 4}, {"month_start": None, "shipments": 9})
    assert [r.shipments for r in monthly.sum_series(frame, "shipments").collect()] == [4]


def test_sum_of_nulls_is_zero(spark):
    frame = history(spark, {"n_fsc": None}, {"n_fsc": None})
    value = monthly.monthly_kpis(frame).where("metric = 'fuel_Surcharge'").first().value
    assert value == 0.0


def test_zero_divisor_gives_null(spark):
    row = monthly.rps_breakdown(history(spark, {"shipments": 2, "n_rev": 10, "cod": 3})).first()
    assert (row.rps, row.rps_zb, row.rps_ncod) == (5.0, None, None)


def test_return_ratio_uses_its_own_month(spark):
    """A month without returns must not shift the months after it."""
    frame = history(
        spark,
        {"month_start": date(2024, 1, 1), "shipments": 100},
        {"month_start": date(2024, 2, 1), "shipments": 10, "ret_ship": 5},
    )
    rows = monthly.monthly_returns(frame).where("metric = 'Shipment_Ret_ration'").collect()
    assert [(r.month_start, r.value) for r in rows] == [(date(2024, 2, 1), 50.0)]


def test_two_digit_labels_do_not_jump_a_century(spark):
    frame = history(
        spark,
        {"month_start": date(1995, 1, 1), "shipments": 1},
        {"month_start": date(2005, 1, 1), "shipments": 2},
    )
    rows = monthly.sum_series(frame, "shipments").collect()
    assert [(r.month_start.year, r.month) for r in rows] == [(1995, "Jan-95"), (2005, "Jan-05")]
