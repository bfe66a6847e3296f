from __future__ import annotations

from basketry.operators.views import register_views
from basketry.plans import reports


def test_views_answer_sql(spark, tables, rows):
    register_views(tables)
    # The first of January and of February 2021: a Friday and a Monday; the 15th is a Friday.
    weekdays = """
        SELECT date_format(order_purchase_timestamp, 'E') AS weekday, count(*) AS orders
        FROM cleaned_orders GROUP BY ALL ORDER BY weekday"""
    assert rows(spark.sql(weekdays)) == [("Fri", 2), ("Mon", 1)]
    dearest = """
        SELECT delivery_status, max(item_revenue) AS dearest
        FROM cleaned_order_items GROUP BY ALL ORDER BY dearest"""
    assert rows(spark.sql(dearest)) == [("On time", 16.0), ("Late", 23.0)]
    several = "SELECT order_id FROM order_payment_totals WHERE payment_method LIKE '%,%'"
    assert rows(spark.sql(several)) == [("o1",)]
    assert spark.sql("SELECT * FROM category_translation").count() == 3


def test_filters_and_columns_reach_the_scan(tables):
    """On stored tables a report reads its own columns and the delivered orders only."""
    plan = reports.delivery_performance(tables)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    read = plan.split("ReadSchema: ")[1]
    assert "order_id" not in read and "order_approved_at" not in read
