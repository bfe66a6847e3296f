"""The relational model: seven tables, their columns, keys and required columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

TEXT, WHOLE, MONEY, MOMENT = "string", "bigint", "decimal(18,4)", "timestamp_ntz"


@dataclass(frozen=True)
class TableSpec:
    """Column types by name, the key, and what must be present for the plans to run."""

    file_name: str
    columns: dict[str, str]
    key: tuple[str, ...]
    required: frozenset[str]
    required_moments: tuple[str, ...] = ()


def _spec(file_name, columns, key, used, required_moments=()):
    # A key column is required too: without it the duplicate check has nothing to group by.
    return TableSpec(file_name, columns, key, frozenset(used) | frozenset(key), required_moments)


# File names, column names and keys of the public marketplace extract.
MODEL: dict[str, TableSpec] = {
    "customers": _spec(
        "olist_customers_dataset.csv",
        {
            "customer_id": TEXT,
            "customer_unique_id": TEXT,
            "customer_zip_code_prefix": TEXT,
            "customer_city": TEXT,
            "customer_state": TEXT,
        },
        ("customer_id",),
        ("customer_unique_id", "customer_state"),
    ),
    "orders": _spec(
        "olist_orders_dataset.csv",
        {
            "order_id": TEXT,
            "customer_id": TEXT,
            "order_status": TEXT,
            "order_purchase_timestamp": MOMENT,
            "order_approved_at": MOMENT,
            "order_delivered_carrier_date": MOMENT,
            "order_delivered_customer_date": MOMENT,
            "order_estimated_delivery_date": MOMENT,
        },
        ("order_id",),
        (
            "customer_id",
            "order_status",
            "order_purchase_timestamp",
            "order_delivered_customer_date",
            "order_estimated_delivery_date",
        ),
        ("order_purchase_timestamp",),
    ),
    "order_items": _spec(
        "olist_order_items_dataset.csv",
        {
            "order_id": TEXT,
            "order_item_id": WHOLE,
            "product_id": TEXT,
            "seller_id": TEXT,
            "shipping_limit_date": MOMENT,
            "price": MONEY,
            "freight_value": MONEY,
        },
        ("order_id", "order_item_id"),
        ("product_id", "price", "freight_value"),
    ),
    "order_payments": _spec(
        "olist_order_payments_dataset.csv",
        {
            "order_id": TEXT,
            "payment_sequential": WHOLE,
            "payment_type": TEXT,
            "payment_installments": WHOLE,
            "payment_value": MONEY,
        },
        ("order_id", "payment_sequential"),
        ("payment_type", "payment_value"),
    ),
    "order_reviews": _spec(
        "olist_order_reviews_dataset.csv",
        {
            "review_id": TEXT,
            "order_id": TEXT,
            "review_score": WHOLE,
            "review_comment_title": TEXT,
            "review_comment_message": TEXT,
            "review_creation_date": MOMENT,
            "review_answer_timestamp": MOMENT,
        },
        # review_id alone repeats in the extract; together with the order it is unique.
        ("review_id", "order_id"),
        ("review_score",),
    ),
    "products": _spec(
        "olist_products_dataset.csv",
        {
            "product_id": TEXT,
            "product_category_name": TEXT,
            "product_name_lenght": WHOLE,
            "product_description_lenght": WHOLE,
            "product_photos_qty": WHOLE,
            "product_weight_g": WHOLE,
            "product_length_cm": WHOLE,
            "product_height_cm": WHOLE,
            "product_width_cm": WHOLE,
        },
        ("product_id",),
        ("product_category_name",),
    ),
    "category_translation": _spec(
        "product_category_name_translation.csv",
        {"product_category_name": TEXT, "product_category_name_english": TEXT},
        ("product_category_name",),
        ("product_category_name_english",),
    ),
}


class Tables:
    """The seven relations as attributes, each opened when a plan first asks for it.

    Opening lists files, which a plan should not pay for a table it does not read. Money
    columns may be decimal or double; moments carry no time zone. `stored` holds derived
    relations that were written out and read back, for plans to use in place of their own
    derivation.
    """

    def __init__(
        self,
        openers: Mapping[str, Callable[[], DataFrame]],
        stored: Mapping[str, DataFrame] | None = None,
    ) -> None:
        if set(openers) != set(MODEL):
            raise ValueError(f"Expected the relations {', '.join(MODEL)}")
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}
        self.stored = dict(stored or {})

    @classmethod
    def of(cls, **frames: DataFrame) -> Tables:
        """Tables from frames that are open already."""
        return cls({name: lambda df=df: df for name, df in frames.items()})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._openers:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = self._openers[name]()
        return self._opened[name]

    def items(self) -> list[tuple[str, DataFrame]]:
        """The seven relations by name."""
        return [(name, getattr(self, name)) for name in MODEL]

    def replaced(self, **frames: DataFrame) -> Tables:
        """The same tables with some of them exchanged."""
        openers = {name: lambda df=df: df for name, df in frames.items()}
        return Tables({**self._openers, **openers}, self.stored)

    def with_stored(self, name: str, df: DataFrame) -> Tables:
        return Tables(self._openers, {**self.stored, name: df})
