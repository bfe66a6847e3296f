from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.operators.cleaning import (
    cleaned_order_items,
    cleaned_orders,
    order_payment_totals,
)
from basketry.sources.extracts import (
    NULL_TOKENS,
    load_tables,
    read_extracts,
    stored_tables,
)
from basketry.sources.model import MODEL


def load(spark, extracts, tmp_path):
    return load_tables(spark, str(extracts), str(tmp_path / "tables"))


def refused(spark, extracts, tmp_path, error, match):
    """The load fails and leaves nothing behind."""
    with pytest.raises(error, match=match):
        load(spark, extracts, tmp_path)
    assert not (tmp_path / "tables").exists()


def test_missing_files_are_named_together(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as error:
        load_tables(spark, str(tmp_path), str(tmp_path / "tables"))
    listed = str(error.value).split(": ")[1].split(", ")
    assert listed == sorted(spec.file_name for spec in MODEL.values())


def test_missing_column(spark, extracts, tmp_path):
    extracts.replace("orders", "order_status", "state_of_order")
    refused(spark, extracts, tmp_path, ValueError, "missing required column.*order_status")


def test_missing_key_column(spark, extracts, tmp_path):
    extracts.replace("order_items", "order_item_id", "position")
    refused(spark, extracts, tmp_path, ValueError, "missing required column.*order_item_id")


def test_null_identifier(spark, extracts, tmp_path):
    extracts.replace("orders", "o1,c1", "NA,c1")
    refused(spark, extracts, tmp_path, ValueError, "orders: every required identifier.*order_id")


def test_null_tokens_are_null_everywhere(spark, extracts, rows):
    lines = [f'k{n},"{token}"' for n, token in enumerate(NULL_TOKENS)]
    text = "\n".join(["product_id,product_category_name", *lines, "kept,nothing"])
    extracts.path("products").write_text(text + "\n")
    products = read_extracts(spark, str(extracts)).products
    assert products.count() == len(NULL_TOKENS) + 1
    named = products.where("product_category_name IS NOT NULL").select("product_id")
    assert rows(named) == [("kept",)]


@pytest.mark.parametrize("text", ["", "2021-13-41 10:00:00"])
def test_invalid_purchase_timestamp(spark, extracts, tmp_path, text):
    extracts.replace("orders", "delivered,2021-01-15 10:00:00", f"delivered,{text}")
    refused(
        spark,
        extracts,
        tmp_path,
        ValueError,
        r"invalid timestamp\(s\) in orders.order_purchase_timestamp",
    )


def test_duplicate_key(spark, extracts, tmp_path):
    extracts.append("orders", "o1,c1,delivered,2021-01-01 10:00:00,,,")
    refused(spark, extracts, tmp_path, ValueError, "1 duplicate key values in orders")


def test_surplus_fields(spark, extracts, tmp_path):
    # An unquoted thousands separator would otherwise shift the amount silently.
    extracts.append("order_payments", "o2,2,boleto,1,1,234.50")
    refused(spark, extracts, tmp_path, ValueError, "more fields than its header")


def test_missing_trailing_fields_are_null(spark, extracts, tmp_path, rows):
    extracts.append("order_reviews", "r3,o3,4")
    assert load(spark, extracts, tmp_path)["order_reviews"] == 3
    reviews = stored_tables(spark, str(tmp_path / "tables")).order_reviews
    kept = reviews.where("review_id = 'r3'").select("review_score", "review_comment_title")
    assert rows(kept) == [(4, None)]


def test_counts_types_and_repeatability(spark, extracts, tmp_path):
    expected = {
        "customers": 3,
        "orders": 4,
        "order_items": 3,
        "order_payments": 4,
        "order_reviews": 2,
        "products": 3,
        "category_translation": 3,
    }
    assert load(spark, extracts, tmp_path) == expected
    assert load(spark, extracts, tmp_path) == expected
    t = stored_tables(spark, str(tmp_path / "tables"))
    assert {name: df.count() for name, df in t.items()} == expected
    item = t.order_items.where("order_id = 'o1'").first()
    assert item.price == Decimal("10.0000")
    assert item.shipping_limit_date == datetime.datetime(2021, 1, 1, 10)
    assert "_malformed" not in t.orders.columns


def test_columns_are_matched_by_name_and_unknown_ones_kept(spark, extracts, rows):
    extracts.path("customers").write_text(
        "customer_state,note,customer_unique_id,customer_id\nSP,NA,u1,c1\nRJ,x,u2,c3\n"
    )
    customers = read_extracts(spark, str(extracts)).customers
    picked = customers.select("customer_id", "customer_unique_id", "customer_state", "note")
    assert rows(picked.orderBy("customer_id")) == [
        ("c1", "u1", "SP", None),
        ("c3", "u2", "RJ", "x"),
    ]


def test_quoted_line_breaks_quotes_and_commas(spark, extracts, tmp_path, rows):
    extracts.append("order_reviews", 'r3,o3,4,"a ""fine"" thing, really","first\nsecond",,')
    assert load(spark, extracts, tmp_path)["order_reviews"] == 3
    reviews = stored_tables(spark, str(tmp_path / "tables")).order_reviews
    texts = reviews.where("review_id = 'r3'").select(
        "review_comment_title", "review_comment_message"
    )
    assert rows(texts) == [('a "fine" thing, really', "first\nsecond")]


def test_extract_as_directory_of_parts(spark, extracts, tmp_path):
    path = extracts.path("customers")
    header, *lines = path.read_text().splitlines()
    parts = tmp_path / "parts"
    parts.mkdir()
    for number, line in enumerate(lines):
        (parts / f"part-{number}.csv").write_text(f"{header}\n{line}\n")
    path.unlink()
    parts.rename(path)
    assert load(spark, extracts, tmp_path)["customers"] == 3


def test_parts_with_other_headers_are_refused(spark, extracts, tmp_path):
    path = extracts.path("order_items")
    header, first, *rest = path.read_text().splitlines()
    swapped = header.replace("price,freight_value", "freight_value,price")
    assert swapped != header
    path.unlink()
    path.mkdir()
    (path / "part-0.csv").write_text("\n".join([header, *rest]) + "\n")
    (path / "part-1.csv").write_text(f"{swapped}\n{first}\n")
    refused(spark, extracts, tmp_path, ValueError, "headers of its parts differ")


def test_fractions_are_no_whole_numbers(spark, extracts, rows):
    extracts.replace("order_reviews", "r1,o1,5", "r1,o1,1.9")
    extracts.replace("order_reviews", "r2,o2,3", "r2,o2,3.0")
    reviews = read_extracts(spark, str(extracts)).order_reviews.orderBy("review_id")
    assert rows(reviews.select("review_score")) == [(None,), (3,)]


def test_dates_in_other_shapes(spark, extracts, rows):
    extracts.replace("orders", "delivered,2021-01-15 10:00:00", "delivered,01/15/2021 10:00")
    extracts.replace("orders", "canceled,2021-03-01 10:00:00", "canceled,2021/03/01T10:00:00")
    orders = read_extracts(spark, str(extracts)).orders
    picked = orders.where("customer_id = 'c3'").orderBy("order_id")
    assert rows(picked.select("order_purchase_timestamp")) == [
        (datetime.datetime(2021, 1, 15, 10),),
        (datetime.datetime(2021, 3, 1, 10),),
    ]


def test_unreadable_amount_is_null(spark, extracts, rows):
    extracts.replace("order_items", "10.0,2.0", "(5),2.0")
    items = read_extracts(spark, str(extracts)).order_items
    assert rows(items.where("order_id = 'o1'").select("price")) == [(None,)]


def test_cleaned_orders(tables, rows):
    picked = cleaned_orders(tables.orders).select(
        "order_id", "delivery_days", "delivery_status"
    )
    assert rows(picked.orderBy("order_id")) == [
        ("o1", 4.0, "On time"),
        ("o2", 8.0, "Late"),
        ("o3", 5.0, "On time"),
    ]


def test_delivery_later_on_the_estimated_day_is_on_time(spark, extracts, rows):
    extracts.replace("orders", "2021-02-09 10:00:00", "2021-02-08 23:59:59")
    orders = cleaned_orders(read_extracts(spark, str(extracts)).orders)
    assert rows(orders.where("order_id = 'o2'").select("delivery_status")) == [("On time",)]


def test_payments_are_summed_once_per_order(spark, extracts, rows):
    extracts.append("order_payments", "o3,2,,1,0.5")
    extracts.append("order_payments", "o3,3,credit_card,1,0.25")
    extracts.append("order_payments", "o4,1,,1,")
    payments = read_extracts(spark, str(extracts)).order_payments
    assert rows(order_payment_totals(payments).orderBy("order_id")) == [
        ("o1", 12.0, "credit_card,voucher"),
        ("o2", 23.0, "boleto"),
        ("o3", 16.75, "credit_card"),
        ("o4", None, None),
    ]


def test_rounding_waits_until_an_order_is_summed(spark, rows):
    payments = spark.createDataFrame(
        [("a", "x", 0.004), ("a", "x", 0.004), ("b", "x", 0.005), ("c", "x", -0.005)],
        "order_id string, payment_type string, payment_value double",
    )
    totals = order_payment_totals(payments).select("order_id", "payment_value")
    assert rows(totals.orderBy("order_id")) == [("a", 0.01), ("b", 0.01), ("c", -0.01)]


def test_cleaned_items_and_category_fallback(spark, extracts, rows):
    extracts.replace("category_translation", "perfumaria,perfume\n", "")
    extracts.replace("products", "p2,beleza_saude", "p2,")
    t = read_extracts(spark, str(extracts))
    items = cleaned_order_items(t)
    assert len(items.columns) == 12
    picked = items.select("order_id", "product_category_name", "category_name", "item_revenue")
    assert rows(picked.orderBy("order_id")) == [
        ("o1", "perfumaria", "perfumaria", 12.0),
        ("o2", None, "Unknown", 23.0),
        ("o3", "esporte_lazer", "sports_leisure", 16.0),
    ]


def test_item_of_unknown_product_is_kept(spark, tables, rows):
    orphan = tables.order_items.withColumn("product_id", F.lit("nowhere"))
    items = cleaned_order_items(tables.replaced(order_items=orphan))
    assert rows(items.select("category_name").distinct()) == [("Unknown",)]
    assert items.count() == 3
