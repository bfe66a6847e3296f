from __future__ import annotations

import pytest

from basketry.plans import quality
from basketry.sources.extracts import read_extracts
from basketry.sources.testdata import open_tables

SUMMARY = "check_name string, violation_count bigint"


def counts(t) -> dict[str, int]:
    found = quality.dq_summary(t).collect()
    assert [row.check_name for row in found] == sorted(quality.CHECKS)
    return {row.check_name: row.violation_count for row in found}


def test_clean_extracts_have_no_violations(tables):
    assert set(counts(tables).values()) == {0}


def test_every_defect_is_counted(spark, extracts):
    extracts.replace("orders", "o1,c1,delivered", "o1,nobody,delivered")
    extracts.replace("orders", "2021-01-05 10:00:00,2021-01-10", "2020-12-31 10:00:00,2020-12-30")
    extracts.replace("order_items", "o1,1,p1", "nowhere,1,nothing")
    extracts.replace("order_items", "10.0,2.0", "-1,")
    extracts.replace("order_payments", "o1,1,credit_card,1,10.0", "nowhere,1,credit_card,1,-1")
    extracts.replace("order_payments", "o1,2,voucher,1,2.0", "nowhere,2,voucher,1,-1")
    extracts.replace("order_reviews", "r1,o1", "r1,nowhere")
    extracts.replace("products", "p1,perfumaria", "p1,untranslated")
    expected = dict.fromkeys(quality.CHECKS, 1)
    expected |= {"payments_missing_order": 2, "payments_invalid_value": 2}
    assert counts(read_extracts(spark, str(extracts))) == expected


def test_null_references_are_missing(spark, tables):
    """A null key matches nothing, not even a null key on the other side."""
    one_null = spark.createDataFrame([(None, 1, "p1")], "order_id string, order_item_id int, product_id string")
    t = tables.replaced(
        orders=tables.orders.selectExpr(
            "if(order_id = 'o1', null, order_id) AS order_id",
            "* EXCEPT (order_id)",
        ),
        order_items=one_null.selectExpr("*", "1.0D AS price", "1.0D AS freight_value"),
    )
    found = counts(t)
    assert found["order_items_missing_order"] == 1
    assert found["delivered_orders_without_payment"] == 1
    assert found["delivered_orders_without_items"] == 3
    assert found["payments_missing_order"] == 2


def test_unnamed_products_need_no_translation(spark, extracts):
    extracts.replace("products", "p1,perfumaria", "p1,")
    assert counts(read_extracts(spark, str(extracts)))["products_without_category_translation"] == 0


def test_policy(spark):
    names = [*quality.CHECKS, "future_check"]
    entries = [(name, count) for name in names for count in (0, 1)]
    found = {
        (row.check_name, row.violation_count): row.status
        for row in quality.dq_policy(spark.createDataFrame(entries, SUMMARY)).collect()
    }
    for name in quality.CHECKS:
        assert found[name, 0] is None
        assert found[name, 1] == ("warning" if name in quality.WARNING_CHECKS else "fatal")
    # An unknown name blocks even without violations.
    assert found["future_check", 0] == found["future_check", 1] == "fatal"


def test_gate_reports_all_fatal_checks(spark):
    summary = [
        ("delivered_orders_without_payment", 1),
        ("orders_missing_customer", 1200),
        ("payments_invalid_value", 2),
        ("reviews_missing_order", 0),
    ]
    with pytest.raises(quality.ValidationPolicyError) as error:
        quality.enforce_policy(spark.createDataFrame(summary, SUMMARY))
    found = [(row.check_name, row.violation_count, row.status) for row in error.value.rows]
    assert [row[:2] for row in found] == summary
    assert [row[2] for row in found[1:3]] == ["fatal", "fatal"]
    assert "2 check(s): orders_missing_customer, payments_invalid_value" in str(error.value)


def test_gate_lets_warnings_pass(spark):
    summary = [("products_without_category_translation", 4), ("reviews_missing_order", 0)]
    assert quality.enforce_policy(spark.createDataFrame(summary, SUMMARY)) == summary


def test_known_counts_of_the_test_tables(spark):
    t = open_tables(spark, "/root/testdata/sf0.001")
    found = counts(t)
    assert found["delivered_orders_without_payment"] == 9
    assert found["delivered_orders_without_items"] == 9
    assert found["products_without_category_translation"] == 37
    repeated = {row.table_name: row.duplicate_keys for row in quality.duplicate_keys(t).collect()}
    assert repeated["order_items"] == 1401
    assert quality.deliveries_without_payment(t).first()[0] == 9
    assert quality.duplicate_orders(t).count() == 0
