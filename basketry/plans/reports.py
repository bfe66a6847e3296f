"""Business reports and the payment-to-item reconciliation.

Rows are reduced to one per join key before every join. The reduction uses the exchange the
join needs anyway, and its map-side half keeps a hot order, customer or product from
reaching one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.calendar import (
    MICROS_PER_DAY,
    month_number,
    month_text,
    exact_ratio,
)
from basketry.functions.money import amount
from basketry.operators.cleaning import (
    DELIVERED,
    PURCHASED,
    categorised_products,
    clean_deliveries,
    deliveries,
    item_cents,
    paid_deliveries,
)
from basketry.sources.model import Tables


def monthly_revenue(t: Tables) -> DataFrame:
    months = paid_deliveries(t).groupBy(month_number(F.col(PURCHASED)).alias("number"))
    return (
        months.agg(amount(F.sum("payment_cents")).alias("revenue"))
        .select(month_text(F.col("number")).alias("month"), "revenue")
        .orderBy("month")
    )


def payment_method(t: Tables) -> DataFrame:
    return (
        paid_deliveries(t, with_methods=True)
        .groupBy("payment_method")
        .agg(
            F.count("*").alias("orders"),
            amount(F.sum("payment_cents")).alias("revenue"),
        )
        .orderBy(F.desc("revenue"), "payment_method")
    )


def delivery_performance(t: Tables) -> DataFrame:
    return (
        clean_deliveries(t)
        .groupBy("delivery_status")
        .agg(F.count("*").alias("orders"))
        .orderBy("delivery_status")
    )


def average_days(micros: Column, orders: Column) -> Column:
    """Elapsed microseconds, a decimal, as average days with two digits."""
    micros_in_days = orders.cast("decimal(12,0)") * F.lit(MICROS_PER_DAY)
    return F.round((micros / micros_in_days).cast("decimal(20,9)"), 2).cast("double")


def delivery_by_state(t: Tables) -> DataFrame:
    """Average delivery days; elapsed microseconds are added exactly and divided once."""
    took = F.timestamp_diff("MICROSECOND", F.col(PURCHASED), F.col(DELIVERED))
    by_customer = (
        clean_deliveries(t)
        .groupBy("customer_id")
        .agg(F.sum(took).cast("decimal(20,0)").alias("micros"), F.count("*").alias("orders"))
    )
    return (
        by_customer.join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(average_days(F.sum("micros"), F.sum("orders")).alias("average_delivery_days"))
        .orderBy(F.desc("average_delivery_days"), "customer_state")
    )


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """Sum and number of scores and whether any was low, per reviewed order of any status."""
    low = F.when(F.col("review_score").isin(1, 2), 1).otherwise(0)
    return reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("points"),
        F.count("review_score").alias("scores"),
        F.max(low).alias("low"),
    )


def review_quality(by_state: DataFrame) -> DataFrame:
    """The report from (customer_state, scores, orders, points, low): a row for each state and
    number of scores that an order has.

    The average of an order is points / scores. Points of orders with as many scores are added as
    whole numbers and divided once, as decimals, so that the result does not depend on the order
    in which rows are added.
    """
    mean = F.col("points").cast("decimal(20,0)") / F.nullif("scores", F.lit(0)).cast("decimal(10,0)")
    scored = F.when(F.col("scores") > 0, F.col("orders")).otherwise(0)
    total = F.sum(mean.cast("decimal(38,15)"))
    average = total / F.nullif(F.sum(scored), F.lit(0)).cast("decimal(12,0)")
    return by_state.groupBy("customer_state").agg(
        F.sum("orders").alias("reviewed_orders"),
        F.round(average.cast("decimal(20,12)"), 2).cast("double").alias("average_review_score"),
        exact_ratio(F.sum("low"), F.sum("orders"), 4).alias("low_score_rate"),
    )


def review_quality_by_state(t: Tables) -> DataFrame:
    reviewed = reviews_by_order(t.order_reviews).join(
        clean_deliveries(t).select("order_id", "customer_id"), "order_id"
    )
    measures = [F.sum(name).alias(name) for name in ("orders", "points", "low")]
    by_customer = (
        reviewed.withColumn("orders", F.lit(1)).groupBy("customer_id", "scores").agg(*measures)
    )
    by_state = (
        by_customer.join(t.customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state", "scores")
        .agg(*measures)
    )
    return review_quality(by_state).orderBy(
        F.desc("low_score_rate"), F.desc("reviewed_orders"), "customer_state"
    )


def revenue_by_category(t: Tables) -> DataFrame:
    items = t.order_items.select(
        "order_id", "product_id", item_cents(t.order_items).alias("cents")
    )
    by_product = (
        items.join(clean_deliveries(t).select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(F.sum("cents").alias("cents"))
    )
    return (
        by_product.join(categorised_products(t), "product_id", "left")
        .groupBy(F.coalesce("category_name", F.lit("Unknown")).alias("category_name"))
        .agg(amount(F.sum("cents")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category_name")
    )


def top_categories(t: Tables, k: int = 3) -> DataFrame:
    """The leading categories by item value."""
    return revenue_by_category(t).limit(k)


def _untranslated_products(t: Tables) -> DataFrame:
    """Products published under their source name, including names translated to themselves."""
    return categorised_products(t).where(
        F.col("product_category_name") == F.col("category_name")
    )


def _total_or_zero(value: str) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def untranslated_item_rows(t: Tables) -> DataFrame:
    """Item rows of clean deliveries that carry no translated category.

    Rows are counted per product before they meet the products.
    """
    by_product = (
        t.order_items.select("order_id", "product_id")
        .join(clean_deliveries(t).select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(F.count("*").alias("rows"))
    )
    marked = _untranslated_products(t).select("product_id")
    return by_product.join(marked, "product_id").agg(
        _total_or_zero("rows").alias("untranslated_item_rows")
    )


def revenue_reconciliation(t: Tables) -> DataFrame:
    """Payments against items plus freight over deliveries that have both.

    The untranslated count covers every clean delivery with items, paid or not.
    """
    by_order = (
        t.order_items.select("order_id", item_cents(t.order_items).alias("cents"))
        .groupBy("order_id")
        .agg(F.sum("cents").alias("item_cents"))
    )
    both = deliveries(t).where("paid is not null").select("order_id", "paid", "payment_cents")
    both = both.join(by_order, "order_id")
    paid_items = F.sum(F.when(F.col("paid"), F.col("item_cents")))
    paid = F.sum("payment_cents")
    return both.agg(
        F.count("paid").alias("paid_delivered_orders"),
        amount(paid).alias("payment_revenue"),
        amount(paid_items).alias("item_revenue"),
        amount(paid - paid_items).alias("payment_item_variance"),
    ).withColumn("untranslated_item_rows", untranslated_item_rows(t).scalar())


RECONCILIATION_SCHEMA = (
    "paid_delivered_orders bigint, payment_revenue double, item_revenue double, "
    "payment_item_variance double, untranslated_item_rows bigint"
)


def calculate_revenue_reconciliation(t: Tables) -> dict[str, float | int]:
    """The reconciliation as a dictionary; refuses an input without a paid delivery."""
    totals = revenue_reconciliation(t).first()
    if totals.payment_revenue is None:
        raise ValueError("No paid delivered orders are available for revenue reconciliation")
    return totals.asDict()


def headline_counts(t: Tables) -> DataFrame:
    """Deliveries, paid deliveries, paying persons and paid purchase months, in one row."""
    by_month = (
        deliveries(t)
        .groupBy(month_number(F.col(PURCHASED)).alias("month"))
        .agg(F.count("*").alias("orders"), F.count("paid").alias("paid"))
    )
    paying = (
        paid_deliveries(t)
        .select("customer_id")
        .distinct()
        .join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .agg(F.countDistinct("customer_unique_id").alias("persons"))
    )
    return by_month.agg(
        _total_or_zero("orders").alias("delivered_orders"),
        _total_or_zero("paid").alias("paid_delivered_orders"),
        F.count_if(F.col("paid") > 0).alias("paid_purchase_months"),
    ).withColumn("unique_customers", paying.scalar())


BUSINESS_REPORTS = {
    "monthly_revenue": monthly_revenue,
    "payment_method": payment_method,
    "delivery_performance": delivery_performance,
    "delivery_by_state": delivery_by_state,
    "review_quality_by_state": review_quality_by_state,
    "revenue_by_category": revenue_by_category,
}
