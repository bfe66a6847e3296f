from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.operators.cleaning import DELIVERIES, deliveries
from basketry.plans import reports
from basketry.sources.extracts import read_extracts
from basketry.sources.testdata import open_tables

EXPECTED = {
    "monthly_revenue": [("2021-01", 28.0), ("2021-02", 23.0)],
    "payment_method": [
        ("boleto", 1, 23.0),
        ("credit_card", 1, 16.0),
        ("credit_card,voucher", 1, 12.0),
    ],
    "delivery_performance": [("Late", 1), ("On time", 2)],
    "delivery_by_state": [("SP", 6.0), ("RJ", 5.0)],
    "review_quality_by_state": [("SP", 2, 4.0, 0.0)],
    "revenue_by_category": [
        ("health_beauty", 23.0),
        ("sports_leisure", 16.0),
        ("perfume", 12.0),
    ],
}


@pytest.mark.parametrize("name", EXPECTED)
def test_business_report(tables, rows, name):
    assert rows(reports.BUSINESS_REPORTS[name](tables)) == EXPECTED[name]


@pytest.mark.parametrize("name", EXPECTED)
def test_business_report_from_stored_deliveries(spark, tables, rows, tmp_path, name):
    path = str(tmp_path / "deliveries")
    deliveries(tables, with_methods=True).write.parquet(path)
    stored = tables.with_stored(DELIVERIES, spark.read.parquet(path))
    assert rows(reports.BUSINESS_REPORTS[name](stored)) == EXPECTED[name]


def test_low_review_marks_its_order_once(spark, extracts, rows):
    extracts.replace("order_reviews", "r2,o2,3", "r2,o2,2")
    t = read_extracts(spark, str(extracts))
    assert rows(reports.review_quality_by_state(t)) == [("SP", 2, 3.5, 0.5)]


def test_averages_are_taken_per_order_first(spark, extracts, rows):
    # o1 averages 2 over three reviews, o2 has 3: 2.5, where review rows would give 2.25.
    extracts.append("order_reviews", "r3,o1,1,,,,")
    extracts.append("order_reviews", "r4,o1,0,,,,")
    t = read_extracts(spark, str(extracts))
    assert rows(reports.review_quality_by_state(t)) == [("SP", 2, 2.5, 0.5)]


def test_unscored_review_counts_as_reviewed_and_not_low(spark, extracts, rows):
    extracts.append("order_reviews", "r3,o3,,,,,")
    t = read_extracts(spark, str(extracts))
    assert rows(reports.review_quality_by_state(t)) == [
        ("SP", 2, 4.0, 0.0),
        ("RJ", 1, None, 0.0),
    ]


def test_several_items_do_not_multiply_payments(spark, extracts, rows):
    extracts.append("order_items", "o1,2,p2,seller1,2021-01-01 10:00:00,1.5,0.5")
    t = read_extracts(spark, str(extracts))
    assert rows(reports.monthly_revenue(t)) == EXPECTED["monthly_revenue"]
    assert rows(reports.revenue_reconciliation(t)) == [(3, 51.0, 53.0, -2.0, 0)]


def test_reconciliation(tables):
    assert reports.calculate_revenue_reconciliation(tables) == {
        "paid_delivered_orders": 3,
        "payment_revenue": 51.0,
        "item_revenue": 51.0,
        "payment_item_variance": 0.0,
        "untranslated_item_rows": 0,
    }


def test_reconciliation_needs_items_and_payments(spark, extracts, rows):
    # o1 has no payment but its untranslated item still counts; o3 has no items.
    extracts.replace("order_payments", "o1,1,credit_card,1,10.0\no1,2,voucher,1,2.0\n", "")
    extracts.replace("order_items", "o3,1,p3,seller2,2021-01-15 10:00:00,15.0,1.0\n", "")
    extracts.replace("category_translation", "perfumaria,perfume\n", "")
    t = read_extracts(spark, str(extracts))
    assert rows(reports.revenue_reconciliation(t)) == [(1, 23.0, 23.0, 0.0, 1)]
    assert rows(reports.untranslated_item_rows(t)) == [(1,)]


def test_category_translated_to_itself_counts_as_untranslated(spark, extracts, rows):
    extracts.replace("category_translation", "perfumaria,perfume", "perfumaria,perfumaria")
    t = read_extracts(spark, str(extracts))
    assert rows(reports.untranslated_item_rows(t)) == [(1,)]
    assert reports.calculate_revenue_reconciliation(t)["untranslated_item_rows"] == 1


def test_reconciliation_refuses_empty_payments(tables):
    unpaid = tables.replaced(order_payments=tables.order_payments.where("false"))
    with pytest.raises(ValueError, match="No paid delivered orders"):
        reports.calculate_revenue_reconciliation(unpaid)


def test_headlines_and_top_categories(tables, rows):
    counts = reports.headline_counts(tables).first().asDict()
    assert counts == {
        "delivered_orders": 3,
        "paid_delivered_orders": 3,
        "paid_purchase_months": 2,
        "unique_customers": 2,
    }
    assert rows(reports.top_categories(tables, 1)) == [("health_beauty", 23.0)]


@pytest.fixture(scope="module")
def test_tables(spark):
    return open_tables(spark, "/root/testdata/sf0.001")


def test_method_and_month_totals_agree(test_tables):
    def total(df):
        return df.agg(F.sum(F.col("revenue").cast("decimal(20,2)"))).first()[0]

    by_month = total(reports.monthly_revenue(test_tables))
    assert by_month == total(reports.payment_method(test_tables))
    assert str(by_month) == "103451785.65"


def test_published_figures_of_the_test_tables(test_tables):
    found = reports.calculate_revenue_reconciliation(test_tables)
    assert found == {
        "paid_delivered_orders": 475,
        "payment_revenue": 103451785.65,
        "item_revenue": 103501722.65,
        "payment_item_variance": -49937.0,
        "untranslated_item_rows": 371,
    }
    assert reports.headline_counts(test_tables).first().delivered_orders == 484


def test_one_exchange_per_keyed_input(test_tables):
    """Payments and orders are each shuffled once by order id before the report's grouping."""
    plan = reports.monthly_revenue(test_tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_id") <= 2
    assert "SinglePartition" not in plan
