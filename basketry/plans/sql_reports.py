"""Reports written in SQL over the named relations of the model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry.operators.views import register_views
from basketry.sources.model import Tables

# How late the late deliveries of a state were, beside the share that was late.
LATENESS_BY_STATE = """
    WITH judged AS (
        SELECT c.customer_state, o.delivery_status,
               datediff(o.order_delivered_customer_date, o.order_estimated_delivery_date) AS days_late
        FROM cleaned_orders o JOIN customers c USING (customer_id)
    )
    SELECT customer_state,
           count(*) AS delivered_orders,
           count_if(delivery_status = 'Late') AS late_orders,
           max(CASE WHEN delivery_status = 'Late' THEN days_late END) AS most_days_late
    FROM judged
    GROUP BY customer_state
    ORDER BY late_orders DESC, customer_state
"""

# Of each year the categories with most deliveries, and what each brought; ties share a place.
LEADING_CATEGORIES_BY_YEAR = """
    WITH by_year AS (
        SELECT year(order_purchase_timestamp) AS purchase_year, category_name,
               count(DISTINCT order_id) AS orders,
               CAST(round(sum(CAST(round(item_revenue * 100) AS BIGINT)) / 100.0, 2) AS DOUBLE)
                   AS revenue
        FROM cleaned_order_items
        GROUP BY ALL
    ), placed AS (
        SELECT *, rank() OVER (PARTITION BY purchase_year ORDER BY orders DESC) AS place
        FROM by_year
    )
    SELECT purchase_year, place, category_name, orders, revenue
    FROM placed
    WHERE place <= 3
    ORDER BY purchase_year, place, category_name
"""


def over_views(t: Tables, sql: str) -> DataFrame:
    """A query over the tables and the cleaned layer, by their names."""
    register_views(t)
    return t.orders.sparkSession.sql(sql)
