"""All reports at once, each relation read once.

Deliveries are stored once with their payments, person and state. From there:

* the reports over deliveries are one aggregate with a grouping set for each report,
* items meet their deliveries once, and one aggregate has a grouping set for products (categories) and
  one for orders (reconciliation),
* reviews meet their deliveries once.

Each part ends in one row that holds the records of its reports as arrays, picked by grouping set. The
arrays are as long as the reports they publish.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.calendar import month_number, month_text
from basketry.functions.money import amount
from basketry.operators.cleaning import (
    DELIVERED,
    PURCHASED,
    categorised_products,
    deliveries,
    item_cents,
)
from basketry.plans import cohorts, reports, rfm
from basketry.sources.model import Tables
from basketry.sources.scratch import stored

VISITS = "visits"


def visits(t: Tables) -> DataFrame:
    """Clean deliveries, one row each, with payments, duration, person and state.

    `known` tells whether the customer exists. One exchange by order for the payments and one by
    customer; a customer with many orders is left to the adaptive skew join.
    """
    if VISITS in t.stored:
        return t.stored[VISITS]
    orders = deliveries(t, with_methods=True).select(
        "order_id",
        "customer_id",
        PURCHASED,
        "delivery_status",
        "payment_method",
        "paid",
        "payment_cents",
        month_number(F.col(PURCHASED)).alias("month"),
        F.timestamp_diff("MICROSECOND", F.col(PURCHASED), F.col(DELIVERED)).alias("micros"),
    )
    customers = t.customers.select(
        "customer_id", "customer_unique_id", "customer_state", F.lit(True).alias("known")
    )
    return orders.join(customers, "customer_id", "left").drop("customer_id")


def shown(value: Column) -> Column:
    """A double as a decimal, which JSON writes without an exponent."""
    return value.cast("decimal(24,4)")


def records(when: Column, *order: Column, **columns: Column) -> Column:
    """An aggregate: the rows that meet a condition as an array of records, in order.

    The sort keys lead the struct because an array of structs sorts by its first fields.
    """
    keys = [key.alias(f"key{position}") for position, key in enumerate(order)]
    record = F.struct(*[columns[name].alias(name) for name in sorted(columns)])
    entry = F.struct(*keys, record.alias("record"))
    entries = F.sort_array(F.collect_list(F.when(when, entry)))
    return F.transform(entries, lambda one: one["record"])


def delivery_reports(v: DataFrame) -> DataFrame:
    """One row: monthly_revenue, payment_method, delivery_performance, delivery_by_state."""
    keys = ["month", "payment_method", "delivery_status", "known", "customer_state"]
    # First one row for each combination, of which there are few, then the sets over these.
    combined = v.groupBy(*keys).agg(
        F.count("*").alias("orders"),
        F.count("paid").alias("paid"),
        F.sum(F.when(F.col("paid"), F.col("payment_cents"))).alias("cents"),
        F.sum("micros").cast("decimal(20,0)").alias("micros"),
    )
    sets = [["month"], ["payment_method"], ["delivery_status"], ["known", "customer_state"]]
    by_set = combined.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("set"),
        *[F.sum(name).alias(name) for name in ("orders", "paid", "cents", "micros")],
    )

    def of(*names: str) -> Column:
        # The bits of the keys that a set leaves out.
        left_out = sum(1 << (len(keys) - 1 - at) for at, key in enumerate(keys) if key not in names)
        return F.col("set") == left_out

    orders, paid = F.col("orders"), F.col("paid")
    revenue = amount(F.col("cents"))
    month = month_text(F.col("month"))
    method, state = F.col("payment_method"), F.col("customer_state")
    days = reports.average_days(F.col("micros"), orders)
    return by_set.agg(
        records(of("month") & (paid > 0), month, month=month, revenue=shown(revenue)).alias(
            "monthly_revenue"
        ),
        records(
            of("payment_method") & (paid > 0),
            -shown(revenue),
            method,
            payment_method=method,
            orders=paid,
            revenue=shown(revenue),
        ).alias("payment_method"),
        records(
            of("delivery_status"),
            F.col("delivery_status"),
            delivery_status=F.col("delivery_status"),
            orders=orders,
        ).alias("delivery_performance"),
        records(
            of("known", "customer_state") & F.col("known"),
            -shown(days),
            state,
            customer_state=state,
            average_delivery_days=shown(days),
        ).alias("delivery_by_state"),
    )


def item_reports(t: Tables, v: DataFrame) -> DataFrame:
    """One row: revenue_by_category and the reconciliation."""
    items = t.order_items.select(
        "order_id", "product_id", item_cents(t.order_items).alias("cents")
    )
    paid_orders = v.select("order_id", "paid", "payment_cents")
    by_set = (
        items.join(paid_orders, "order_id")
        .groupingSets([["product_id"], ["order_id"]], "product_id", "order_id")
        .agg(
            (F.grouping("product_id") == 1).alias("of_order"),
            F.sum("cents").alias("cents"),
            F.count("*").alias("rows"),
            F.max("paid").alias("paid"),
            F.max("payment_cents").alias("payment"),
        )
    )
    # Orders match no product; their keys differ, so that they are not all in one task.
    no_product = F.concat(F.lit("\0"), F.coalesce("order_id", F.lit("")))
    keyed = by_set.withColumn(
        "key", F.when(F.col("of_order"), no_product).otherwise(F.col("product_id"))
    )
    products = categorised_products(t).select(
        F.col("product_id").alias("key"),
        "category_name",
        (F.col("product_category_name") == F.col("category_name")).alias("untranslated"),
    )
    met = keyed.join(products, "key", "left")
    paid = F.col("of_order") & F.col("paid")
    by_category = met.groupBy(
        "of_order", F.coalesce("category_name", F.lit("Unknown")).alias("category_name")
    ).agg(
        F.sum("cents").alias("cents"),
        F.sum(F.when(F.col("untranslated"), F.col("rows"))).alias("untranslated"),
        F.count(F.when(paid, 1)).alias("paid_orders"),
        F.sum(F.when(paid, F.col("payment"))).alias("payments"),
        F.sum(F.when(paid, F.col("cents"))).alias("paid_items"),
    )
    revenue = shown(amount(F.col("cents")))
    payments, items_paid = F.sum("payments"), F.sum("paid_items")
    reconciliation = F.struct(
        shown(amount(items_paid)).alias("item_revenue"),
        F.sum("paid_orders").alias("paid_delivered_orders"),
        shown(amount(payments - items_paid)).alias("payment_item_variance"),
        shown(amount(payments)).alias("payment_revenue"),
        F.coalesce(F.sum("untranslated"), F.lit(0)).alias("untranslated_item_rows"),
    )
    return by_category.agg(
        records(
            ~F.col("of_order"),
            -revenue,
            F.col("category_name"),
            category_name=F.col("category_name"),
            revenue=revenue,
        ).alias("revenue_by_category"),
        reconciliation.alias("reconciliation"),
    )


def review_report(t: Tables, v: DataFrame) -> DataFrame:
    """One row: review_quality_by_state."""
    reviewed = reports.reviews_by_order(t.order_reviews).join(
        v.where("known").select("order_id", "customer_state"), "order_id"
    )
    by_state = reviewed.groupBy("customer_state", "scores").agg(
        F.count("*").alias("orders"), F.sum("points").alias("points"), F.sum("low").alias("low")
    )
    state, orders = F.col("customer_state"), F.col("reviewed_orders")
    rate = shown(F.col("low_score_rate"))
    return reports.review_quality(by_state).agg(
        records(
            F.lit(True),
            -rate,
            -orders,
            state,
            customer_state=state,
            reviewed_orders=orders,
            average_review_score=shown(F.col("average_review_score")),
            low_score_rate=rate,
        ).alias("review_quality_by_state")
    )


def segment_report(v: DataFrame) -> DataFrame:
    """One row: the RFM segments."""
    persons = rfm.persons_of(v.where("paid and known"))
    segments = rfm.rfm_segments(rfm.scored(persons))
    return segments.agg(
        records(
            F.lit(True),
            F.col("segment"),
            segment=F.col("segment"),
            customers=F.col("customers"),
            revenue=shown(F.col("revenue")),
        ).alias("rfm_segments")
    )


def retention_report(v: DataFrame) -> DataFrame:
    """One row: the cohort retention."""
    known = v.where("known and customer_unique_id is not null")
    span = known.agg(F.min("month").alias("first"), F.max("month").alias("last")).first()
    span = (0, 0) if span.first is None else (span.first, span.last - span.first + 1)
    coded = cohorts.months_of(known, "customer_unique_id", span)
    retention = cohorts.retention_of(cohorts.active_months(coded, span))
    names = ("active_customers", "cohort_customers", "cohort_index", "cohort_month")
    return retention.agg(
        records(
            F.lit(True),
            F.col("cohort_month"),
            F.col("cohort_index"),
            retention_rate=shown(F.col("retention_rate")),
            **{name: F.col(name) for name in names},
        ).alias("cohort_retention")
    )


def all_reports(t: Tables) -> dict[str, DataFrame]:
    """The parts as one-row tables; deliveries are stored on the way."""
    v = t.stored.get(VISITS)
    if v is None:
        v = stored(visits(t), VISITS)
    return {
        "deliveries": delivery_reports(v),
        "items": item_reports(t, v),
        "reviews": review_report(t, v),
        "segments": segment_report(v),
        "retention": retention_report(v),
    }
