"""The cleaned layer: delivered orders, payments per order, priced items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.calendar import days_between
from basketry.functions.money import amount, fine_units, to_cents
from basketry.operators.bits import bit_words, members, word_names
from basketry.sources.model import Tables

PURCHASED = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
ESTIMATED = "order_estimated_delivery_date"

# Name under which the job stores the shared relation.
DELIVERIES = "deliveries"


def is_clean_delivery() -> Column:
    """Delivered, with every timestamp the delivery measures need."""
    return (
        (F.col("order_status") == "delivered")
        & F.col(PURCHASED).isNotNull()
        & F.col(DELIVERED).isNotNull()
        & F.col(ESTIMATED).isNotNull()
    )


def cleaned_orders(orders: DataFrame) -> DataFrame:
    """One row per clean delivery with its duration and punctuality; a scan, no shuffle."""
    on_time = F.to_date(DELIVERED) <= F.to_date(ESTIMATED)
    return orders.where(is_clean_delivery()).select(
        "order_id",
        "customer_id",
        "order_status",
        PURCHASED,
        DELIVERED,
        ESTIMATED,
        days_between(F.col(PURCHASED), F.col(DELIVERED)).alias("delivery_days"),
        F.when(on_time, "On time").otherwise("Late").alias("delivery_status"),
    )


def method_names(payments: DataFrame) -> list[str]:
    """The distinct payment methods in order: a list of names, whatever the number of payments."""
    rows = payments.select("payment_type").where("payment_type is not null").distinct().collect()
    return sorted((row.payment_type for row in rows), key=str.encode)


def payments_by_order(payments: DataFrame, methods: Sequence[str] | None = None) -> DataFrame:
    """Payment cents per order, for orders of any status, and its distinct methods in order.

    The methods are a set of bits over `methods`, which names them all; without it the column is
    left out. One grouping computes both, in a hash aggregate with buffers of fixed size.
    """
    fine = fine_units(payments, "payment_value").alias("fine")
    if methods is None:
        return payments.select("order_id", fine).groupBy("order_id").agg(
            to_cents(F.sum("fine")).alias("payment_cents")
        )
    domain = F.array(*[F.lit(name) for name in methods]).cast("array<string>")
    names = word_names("methods", len(methods))
    number = F.array_position(domain, F.col("payment_type")) - 1
    words = bit_words(number, len(methods))
    coded = payments.select(
        "order_id", fine, *[word.alias(name) for word, name in zip(words, names)]
    )
    grouped = coded.groupBy("order_id").agg(
        F.sum("fine").alias("fine"), *[F.bit_or(name).alias(name) for name in names]
    )
    used = F.transform(
        members([F.col(name) for name in names], len(methods)), lambda at: F.get(domain, at)
    )
    some = F.lit(False)
    for name in names:
        some = some | (F.col(name) != 0)
    return grouped.select(
        "order_id",
        to_cents(F.col("fine")).alias("payment_cents"),
        F.when(some, F.array_join(used, ",")).alias("payment_method"),
    )


def order_payment_totals(payments: DataFrame) -> DataFrame:
    """The published form of :func:`payments_by_order`."""
    return payments_by_order(payments, method_names(payments)).select(
        "order_id", amount(F.col("payment_cents")).alias("payment_value"), "payment_method"
    )


def deliveries(t: Tables, with_methods: bool = False) -> DataFrame:
    """Clean deliveries with what was paid for each; `paid` is null without a payment row.

    The relation most reports start from: one row per order, two exchanges by order id. The
    methods are coded only where they are asked for, since their names have to be known first.
    """
    if DELIVERIES in t.stored:
        return t.stored[DELIVERIES]
    names = method_names(t.order_payments) if with_methods else None
    payments = payments_by_order(t.order_payments, names).withColumn("paid", F.lit(True))
    return cleaned_orders(t.orders).join(payments, "order_id", "left")


def clean_deliveries(t: Tables) -> DataFrame:
    """Clean deliveries without regard to payment, hence without the join to them."""
    return t.stored[DELIVERIES] if DELIVERIES in t.stored else cleaned_orders(t.orders)


def paid_deliveries(t: Tables, with_methods: bool = False) -> DataFrame:
    """Clean deliveries with a payment row; Catalyst turns the left join into an inner one."""
    return deliveries(t, with_methods).where("paid")


def item_cents(items: DataFrame) -> Column:
    """Price plus freight of one item row, rounded to cents; null if either is missing."""
    return to_cents(fine_units(items, "price") + fine_units(items, "freight_value"))


def categorised_products(t: Tables) -> DataFrame:
    """Products with the published category name: English, else the source name, else Unknown."""
    translated = t.products.select("product_id", "product_category_name").join(
        t.category_translation.select(
            "product_category_name", "product_category_name_english"
        ),
        "product_category_name",
        "left",
    )
    return translated.select(
        "product_id",
        "product_category_name",
        F.coalesce(
            "product_category_name_english", "product_category_name", F.lit("Unknown")
        ).alias("category_name"),
    )


def cleaned_order_items(t: Tables) -> DataFrame:
    """Items of clean deliveries with category and revenue, one output row per item row.

    Row-level output cannot be pre-aggregated, so a hot order or product is left to the
    adaptive skew join, which splits the item side of both joins.
    """
    items = t.order_items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "price",
        "freight_value",
        amount(item_cents(t.order_items)).alias("item_revenue"),
    )
    orders = cleaned_orders(t.orders).select(
        "order_id", "customer_id", PURCHASED, "delivery_days", "delivery_status"
    )
    return (
        items.join(orders, "order_id")
        .join(categorised_products(t), "product_id", "left")
        .select(
            "order_id",
            "customer_id",
            PURCHASED,
            "delivery_days",
            "delivery_status",
            "order_item_id",
            "product_id",
            "price",
            "freight_value",
            "product_category_name",
            F.coalesce("category_name", F.lit("Unknown")).alias("category_name"),
            "item_revenue",
        )
    )
