"""The data-quality checks, their policy and the gate in front of the analysis."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from basketry.operators.audit import repeated_keys
from basketry.operators.cleaning import DELIVERED, ESTIMATED, PURCHASED, is_clean_delivery
from basketry.operators.ledger import Entry, JointLedger, key_ledger, unmatched
from basketry.sources.model import MODEL, Tables

# Check names and the two that only warn.
CHECKS = (
    "orders_missing_customer",
    "order_items_missing_order",
    "order_items_missing_product",
    "payments_missing_order",
    "reviews_missing_order",
    "order_items_invalid_price",
    "order_items_invalid_freight",
    "payments_invalid_value",
    "delivered_before_purchase",
    "estimated_before_purchase",
    "delivered_orders_without_payment",
    "delivered_orders_without_items",
    "products_without_category_translation",
)
WARNING_CHECKS = (
    "delivered_orders_without_payment",
    "products_without_category_translation",
)


def _missing_or_negative(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) < 0)


def _wide_summary(t: Tables) -> DataFrame:
    """Every check as a column of one row: a scan per table and one exchange of counts by key.

    Items, payments and orders bring their value checks along with their rows.
    """
    order, customer = F.col("order_id"), F.col("customer_id")
    product, category = F.col("product_id"), F.col("product_category_name")
    one = F.lit(1)
    clean = F.when(is_clean_delivery(), 1).otherwise(0)
    # A product without a category is not looked for among the translations.
    named = F.when(category.isNotNull(), 1).otherwise(0)
    ledger = JointLedger(
        {
            "orders": (
                t.orders,
                {
                    "order": Entry(order, {"orders": one, "deliveries": clean}),
                    "customer": Entry(customer, {"orders": one}),
                },
                {
                    "delivered_before_purchase": F.col(DELIVERED) < F.col(PURCHASED),
                    "estimated_before_purchase": F.col(ESTIMATED) < F.col(PURCHASED),
                },
            ),
            "items": (
                t.order_items,
                {
                    "order": Entry(order, {"items": one}),
                    "product": Entry(product, {"items": one}),
                },
                {
                    "order_items_invalid_price": _missing_or_negative("price"),
                    "order_items_invalid_freight": _missing_or_negative("freight_value"),
                },
            ),
            "payments": (
                t.order_payments,
                {"order": Entry(order, {"payments": one})},
                {"payments_invalid_value": _missing_or_negative("payment_value")},
            ),
            "reviews": (t.order_reviews, {"order": Entry(order, {"reviews": one})}, {}),
            "customers": (t.customers, {"customer": Entry(customer, {"customers": one})}, {}),
            "products": (
                t.products,
                {
                    "product": Entry(product, {"products": one}),
                    "category": Entry(category, {"products": named}),
                },
                {},
            ),
            "translations": (
                t.category_translation,
                {"category": Entry(category, {"translations": one})},
                {},
            ),
        }
    )
    unmatched_rows = {
        "orders_missing_customer": ("customer", "orders", "customers"),
        "order_items_missing_order": ("order", "items", "orders"),
        "order_items_missing_product": ("product", "items", "products"),
        "payments_missing_order": ("order", "payments", "orders"),
        "reviews_missing_order": ("order", "reviews", "orders"),
        "delivered_orders_without_payment": ("order", "deliveries", "payments"),
        "delivered_orders_without_items": ("order", "deliveries", "items"),
        "products_without_category_translation": ("category", "products", "translations"),
    }
    flaws = [name for name in CHECKS if name not in unmatched_rows]
    return ledger.rows.agg(
        *[ledger.unmatched(*of).alias(name) for name, of in unmatched_rows.items()],
        *[ledger.flawed(name).alias(name) for name in flaws],
    )


def dq_summary(t: Tables) -> DataFrame:
    """Every check with its violation count, sorted by name."""
    wide = _wide_summary(t)
    return wide.unpivot([], wide.columns, "check_name", "violation_count").orderBy("check_name")


def check_status(name: Column, violations: Column) -> Column:
    """warning, fatal or null; a name outside the known checks is fatal even at zero."""
    return (
        F.when(name.isNull() | ~name.isin(*CHECKS), "fatal")
        .when(violations == 0, None)
        .when(name.isin(*WARNING_CHECKS), "warning")
        .otherwise("fatal")
    )


def dq_policy(summary: DataFrame) -> DataFrame:
    """A check summary with the status of every check."""
    return summary.select(
        "check_name",
        "violation_count",
        check_status(F.col("check_name"), F.col("violation_count")).alias("status"),
    )


class ValidationPolicyError(ValueError):
    """The gate is shut. `rows` is the policy, a row for each check."""

    def __init__(self, rows) -> None:
        self.rows = list(rows)
        fatal = [row for row in self.rows if row.status == "fatal"]
        names = ", ".join(row.check_name for row in fatal)
        found = "; ".join(f"{row.check_name} in {row.violation_count} rows" for row in fatal)
        super().__init__(f"The gate stays shut for {len(fatal)} check(s): {names} ({found})")


def enforce_policy(summary: DataFrame) -> list[tuple[str, int]]:
    """The summary, a pair for each check, or an error if any check is fatal."""
    rows = dq_policy(summary).orderBy("check_name").collect()
    if any(row.status == "fatal" for row in rows):
        raise ValidationPolicyError(rows)
    return [(row.check_name, row.violation_count) for row in rows]


def row_counts(t: Tables) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in t.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def duplicate_orders(t: Tables) -> DataFrame:
    """Order ids that occur more than once."""
    counted = t.orders.groupBy("order_id").agg(F.count("*").alias("duplicate_rows"))
    return counted.where("duplicate_rows > 1")


def duplicate_payments(t: Tables) -> DataFrame:
    """Payment keys that occur more than once."""
    key = MODEL["order_payments"].key
    counted = t.order_payments.groupBy(*key).agg(F.count("*").alias("duplicate_rows"))
    return counted.where("duplicate_rows > 1")


def deliveries_without_date(t: Tables) -> DataFrame:
    """Delivered orders without a readable delivery date, which cleaning leaves out."""
    undated = (F.col("order_status") == "delivered") & F.col(DELIVERED).isNull()
    return t.orders.agg(F.count_if(undated).alias("delivered_without_delivery_date"))


def deliveries_without_payment(t: Tables) -> DataFrame:
    """The number of clean deliveries without a payment row."""
    key = "order_id"
    deliveries = t.orders.where(is_clean_delivery())
    return key_ledger(key, {"deliveries": deliveries, "payments": t.order_payments}).agg(
        unmatched(key, "deliveries", "payments").alias("delivered_orders_without_payment")
    )


def _nulls(t: Tables, columns_of) -> DataFrame:
    """Null values in some columns of each table, without an exchange of rows."""
    counted = []
    for name, df in t.items():
        columns = columns_of(MODEL[name])
        if columns:
            nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            long = nulls.unpivot([], list(columns), "column_name", "violations")
            counted.append(long.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, counted)


def null_identifiers(t: Tables) -> DataFrame:
    """Null values per key column; counted where the rows are."""
    return _nulls(t, lambda spec: spec.key)


def invalid_timestamps(t: Tables) -> DataFrame:
    """Null or unreadable values per required moment; counted where the rows are."""
    return _nulls(t, lambda spec: spec.required_moments)


def duplicate_keys(t: Tables) -> DataFrame:
    """Rows beyond the first of each key, per table."""
    return repeated_keys(t)
