from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelscope.functions import dates, numbers, text
from parcelscope.functions.shipments import left_closed_band
from parcelscope.params import ReviewParams, load_params
from parcelscope.sources.warehouse import month_predicates


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("value", [0.125, 2.5, 1.275, 2.675, 0.135, 1.005, 20351.295, -0.335, 1e9 / 7])
def test_rounds_as_numpy(spark, value):
    assert one(spark, numbers.rounded(F.lit(value))) == np.round(value, 2)


def test_half_even(spark):
    assert one(spark, numbers.rounded(F.lit(0.125))) == 0.12
    assert one(spark, numbers.rounded(F.lit(2.5), 0)) == 2.0


def test_ratio_of_zero(spark):
    assert one(spark, numbers.ratio(F.lit(1), F.lit(0))) is None


def test_text(spark):
    assert one(spark, text.thousands(F.lit(1234567.891))) == "1,234,567.89"
    assert one(spark, text.thousands(F.lit(1234567), 0)) == "1,234,567"
    assert one(spark, text.percent_text(F.lit(12.344))) == "12.34%"
    assert one(spark, text.accounting(F.lit(-5.0))) == "(5.0)"
    assert one(spark, text.accounting(F.lit(5.25))) == "5.25"
    assert one(spark, text.accounting(F.lit(-9.4), 0)) == "(9)"
    assert one(spark, text.plain(F.lit(71738677.8))) == "71738677.8"


def test_month_labels(spark):
    assert one(spark, dates.parse_label(F.lit("Jan-95"))) == date(1995, 1, 1)
    assert one(spark, dates.parse_label(F.lit("Jan-05"))) == date(2005, 1, 1)
    assert one(spark, dates.parse_label(F.lit("nonsense"))) is None


def test_bands_are_left_closed(spark):
    edges = (0, 50, 100)
    bands = [one(spark, left_closed_band(F.lit(v), edges)) for v in (0, 49, 50, 99, 100)]
    assert bands == [1, 1, 2, 2, None]


def test_month_arithmetic():
    assert dates.window_months(date(2024, 2, 29), 6) == (date(2023, 9, 1), date(2024, 2, 1))
    assert dates.month_end(date(2024, 2, 10)) == date(2024, 2, 29)
    assert len(dates.month_span(date(1995, 1, 1), date(1996, 1, 31))) == 13


def test_jdbc_reads_run_month_by_month():
    clauses = month_predicates("normal_cn_date", date(2023, 12, 5), date(2024, 1, 31))
    assert clauses == [
        "normal_cn_date < '2023-12-01' OR normal_cn_date IS NULL",
        "normal_cn_date >= '2023-12-01' AND normal_cn_date < '2024-01-01'",
        "normal_cn_date >= '2024-01-01' AND normal_cn_date < '2024-02-01'",
        "normal_cn_date >= '2024-02-01'",
    ]


def test_params_from_json(spark, tmp_path):
    path = tmp_path / "review.json"
    path.write_text(
        """{"cur": "2024-05-01", "n_months": 6,
            "working_days": {"2024-04-01": 20, "2024-05-01": 23},
            "band_edges": [0, 50, 100], "key_accounts": ["KHI-1"],
            "lifecycle_year": 2024, "min_weight_per_shipment": 0.5}"""
    )
    params = load_params(spark, str(path))
    assert params == ReviewParams(
        cur=date(2024, 5, 1),
        working_days={date(2024, 4, 1): 20, date(2024, 5, 1): 23},
        band_edges=(0, 50, 100),
        key_accounts=("KHI-1",),
        lifecycle_year=2024,
    )
    assert params.pair == {"prev": date(2024, 4, 1), "cur": date(2024, 5, 1)}
    assert params.pair_range == (date(2024, 4, 1), date(2024, 5, 31))
