"""The seven relations derived from the TPC-H-like test tables.

Every relation covers its whole source table. Deterministic arithmetic stands in for what
the test tables lack (persons with several ids, delivery dates, missing categories).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.sources.model import Tables

# The columns in use. A given schema spares a job per table that reads file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
    "part": "p_partkey bigint, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
}

Read = Callable[[str], DataFrame]


def _reader(spark: SparkSession, sf_dir: str) -> Read:
    return lambda name: spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _key(column: str) -> Column:
    return F.col(column).cast("string")


def _broken(column: str, when: Column) -> Column:
    """A key that a property of the row makes point nowhere."""
    return F.when(when, F.concat(F.lit("x"), F.col(column))).otherwise(_key(column))


def _days_after(start: str, days: Column, hours: Column | None = None) -> Column:
    hours = F.lit(0) if hours is None else hours.cast("int")
    return F.col(start) + F.make_dt_interval(days.cast("int"), hours)


def _customers(read: Read, customer_id: Column, person: Column | None = None) -> DataFrame:
    person = F.lit(True) if person is None else person
    in_nation = F.col("c_nationkey") == F.col("n_nationkey")
    return read("customer").join(read("nation"), in_nation).select(
        customer_id.alias("customer_id"),
        # Two ids per person, as a person gets a new id with an order.
        F.when(person, F.concat(F.lit("u"), F.expr("c_custkey div 2"))).alias(
            "customer_unique_id"
        ),
        F.col("n_name").alias("customer_state"),
    )


def _orders(orders: DataFrame, delivered: Column, estimated: Column) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing")
    )
    return orders.select(
        _key("o_orderkey").alias("order_id"),
        _key("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        delivered.alias("order_delivered_customer_date"),
        estimated.alias("order_estimated_delivery_date"),
    )


def _items(read: Read, order: Column, product: Column, price: Column, freight: Column):
    return read("lineitem").select(
        order.alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        product.alias("product_id"),
        price.alias("price"),
        freight.alias("freight_value"),
    )


def _payments(read: Read, order: Column, value: Column) -> DataFrame:
    kind = (
        F.when(F.col("l_returnflag") == "A", "credit_card")
        .when(F.col("l_returnflag") == "N", "boleto")
        .otherwise("voucher")
    )
    return read("lineitem").select(
        order.alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("payment_sequential"),
        kind.alias("payment_type"),
        value.alias("payment_value"),
    )


def _reviews(read: Read, order: Column) -> DataFrame:
    return read("lineitem").select(
        _key("l_linenumber").alias("review_id"),
        order.alias("order_id"),
        (F.col("l_quantity").cast("bigint") % 5 + 1).alias("review_score"),
    )


def _products(read: Read) -> DataFrame:
    category = F.when(F.col("p_brand") != "Brand#1", F.col("p_type"))
    return read("part").select(
        _key("p_partkey").alias("product_id"), category.alias("product_category_name")
    )


def _translation(read: Read) -> DataFrame:
    # PROMO stays untranslated, which exercises the fallback to the source name.
    return (
        read("part")
        .where(F.col("p_type") != "PROMO")
        .select(F.col("p_type").alias("product_category_name"))
        .distinct()
        .withColumn("product_category_name_english", F.lower("product_category_name"))
    )


def open_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The model over the test tables, with consistent references."""
    read = _reader(spark, sf_dir)
    # Some orders never get a delivery date, so that the timestamp filter has work to do.
    arrival = _days_after("o_orderdate", F.col("o_orderkey") % 40, F.col("o_custkey") % 24)
    delivered = F.when(F.col("o_orderkey") % 50 != 0, arrival)
    estimated = _days_after("o_orderdate", F.col("o_custkey") % 25 + 10)
    order, price = _key("l_orderkey"), F.col("l_extendedprice")
    return Tables(
        {
            "customers": lambda: _customers(read, _key("c_custkey")),
            "orders": lambda: _orders(read("orders"), delivered, estimated),
            "order_items": lambda: _items(
                read, order, _key("l_partkey"), price, F.col("l_quantity")
            ),
            "order_payments": lambda: _payments(read, order, price),
            "order_reviews": lambda: _reviews(read, order),
            "products": lambda: _products(read),
            "category_translation": lambda: _translation(read),
        }
    )


def open_defective_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The same model with every kind of defect the quality checks look for.

    References are broken by renaming keys on a property of the row, never by dropping
    rows, so the checks still read the whole tables.
    """
    read = _reader(spark, sf_dir)
    estimated = _days_after("o_orderdate", F.col("o_custkey") % 25 - 5)
    price, freight = F.col("l_quantity") - 2, F.col("l_quantity") - 3

    def orders_with_first_shipment() -> DataFrame:
        first = read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.min("l_shipdate").alias("first_shipped")
        )
        return read("orders").join(first, "o_orderkey", "left")

    return Tables(
        {
            "customers": lambda: _customers(
                read, _broken("c_custkey", F.col("c_acctbal") < 0)
            ),
            "orders": lambda: _orders(
                orders_with_first_shipment(), F.col("first_shipped"), estimated
            ),
            "order_items": lambda: _items(
                read,
                _broken("l_orderkey", F.col("l_tax") == 0),
                _broken("l_partkey", F.col("l_discount") == 0),
                price,
                F.when(F.col("l_linestatus") == "O", freight),
            ),
            "order_payments": lambda: _payments(
                read,
                _broken("l_orderkey", F.col("l_returnflag") == "A"),
                F.col("l_quantity") - 4,
            ),
            "order_reviews": lambda: _reviews(
                read, _broken("l_orderkey", F.col("l_returnflag") == "R")
            ),
            "products": lambda: _products(read),
            "category_translation": lambda: _translation(read),
        }
    )


def open_incomplete_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The consistent relations, but for missing keys, moments and persons, and repeated orders."""
    read, whole = _reader(spark, sf_dir), open_tables(spark, sf_dir)

    def orders() -> DataFrame:
        key = F.col("order_id").cast("bigint")
        # Neighbours share an id, some have none, and some have no time of purchase.
        renamed = F.when(key % 97 != 0, F.when(key % 10 == 1, key - 1).otherwise(key))
        purchased = F.when(key % 89 != 0, F.col("order_purchase_timestamp"))
        return whole.orders.withColumns(
            {"order_id": renamed.cast("string"), "order_purchase_timestamp": purchased}
        )

    return whole.replaced(
        orders=orders(),
        customers=_customers(read, _key("c_custkey"), F.col("c_custkey") % 7 != 0),
    )


def open_anonymous_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The consistent relations with customers whose person is not known."""
    read = _reader(spark, sf_dir)
    customers = _customers(read, _key("c_custkey"), F.col("c_custkey") % 7 != 0)
    return open_tables(spark, sf_dir).replaced(customers=customers)
