from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.functions import labels
from basketry.functions.calendar import half_even, month_number, month_text
from basketry.plans.charts import value_label


@pytest.fixture(scope="module")
def text(spark):
    return lambda column: spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("function", "value", "expected"),
    [
        (labels.brl, 15421082.85, "R$ 15.421.082,85"),
        (lambda v: labels.brl(v, 0), 15421082.85, "R$ 15.421.083"),
        (labels.brl, -1234.5, "R$ -1.234,50"),
        (labels.brl, 0.125, "R$ 0,12"),
        (labels.brl_compact, 15421082.85, "R$ 15,4M"),
        (labels.brl_compact, 1234.5, "R$ 1,2k"),
        (labels.brl_compact, -2500000.0, "R$ -2,5M"),
        (labels.brl_compact, 999.99, "R$ 999,99"),
        (labels.brl_tick, 1200000.0, "R$ 1,2M"),
        (labels.brl_tick, 45000.0, "R$ 45k"),
        (labels.brl_tick, 12.0, "R$ 12"),
        (lambda v: labels.percent(v, 2), 0.0049, "0,49%"),
        (labels.percent, 0.25, "25,0%"),
        (labels.percent, 1.0, "100,0%"),
        (labels.percent, 12.345, "1.234,5%"),
        (labels.integer, 58673.0, "58.673"),
        (labels.days, 29.39, "29.4 d"),
        (labels.days, 0.25, "0.2 d"),
    ],
)
def test_numbers(text, function, value, expected):
    assert text(function(F.lit(value))) == expected


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("2021-01", "Jan 2021"),
        ("SP", "SP"),
        ("credit_card,voucher", "Credit Card + Voucher"),
        (" boleto ", "Boleto"),
        ("home-app 3d", "Home-App 3D"),
        ("At Risk", "At Risk"),
        ("SPX", "Spx"),
    ],
)
def test_readable(text, raw, expected):
    assert text(labels.readable(F.lit(raw))) == expected


@pytest.mark.parametrize(
    ("column", "expected"),
    [("revenue", "R$ 1,5k"), ("average_delivery_days", "1500.0 d"), ("customers", "1.500")],
)
def test_value_label_follows_the_measure(spark, column, expected):
    df = spark.createDataFrame([(1500.0,)], f"{column} double")
    assert df.select(value_label(column).alias("v")).first().v == expected


def test_months(text):
    moment = F.lit("2021-01-31 23:59:59").cast("timestamp_ntz")
    assert text(month_text(month_number(moment))) == "2021-01"
    december = F.lit("2020-12-01").cast("timestamp_ntz")
    assert text(month_text(month_number(december))) == "2020-12"
    assert text(month_number(moment) - month_number(december)) == 1


@pytest.mark.parametrize(
    ("value", "expected"), [(0.03125, 0.0312), (0.03135, 0.0314), (2 / 3, 0.6667)]
)
def test_rates_round_half_to_even(text, value, expected):
    assert text(half_even(F.lit(value), 4)) == expected
