from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from basketry.operators.bits import bit_words, members, word_names
from basketry.operators.cleaning import order_payment_totals
from basketry.plans import cohorts, reports


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [0, 1, 62, 63, 64, 126, 200])
def test_sets_come_back_in_order(spark, size):
    numbers = [n for n in range(size) if n % 7 in (0, 3, 6) or n in (62, 63)]
    rows = [(key, n) for n in numbers for key in ("a", "b") if key == "a" or n % 2] + [("c", None)]
    df = spark.createDataFrame(rows, "key string, n int")
    names = word_names("w", size)
    coded = df.select("key", *[w.alias(x) for w, x in zip(bit_words(F.col("n"), size), names)])
    sets = coded.groupBy("key").agg(*[F.bit_or(x).alias(x) for x in names])
    found = sets.select("key", members([F.col(x) for x in names], size).alias("set"))
    kept = {row["key"]: row["set"] for row in found.collect()}
    assert kept.pop("c") == []
    assert kept.get("a", []) == numbers
    assert kept.get("b", []) == [n for n in numbers if n % 2]


def test_more_methods_than_a_word_has_bits(spark, rows):
    kinds = [f"m{n:03d}" for n in range(150)] + ["é", "Z"]
    payments = [("all", kind, 1.0) for kind in reversed(kinds)] * 2
    payments += [("one", kinds[100], 2.0), ("one", None, 1.0), ("none", None, None)]
    df = spark.createDataFrame(payments, "order_id string, payment_type string, payment_value double")
    found = {row["order_id"]: row["payment_method"] for row in order_payment_totals(df).collect()}
    assert found == {"all": ",".join(["Z", *kinds[:150], "é"]), "one": "m100", "none": None}


def test_payments_without_any_method(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 1.0)], "order_id string, payment_type string, payment_value double"
    )
    assert rows(order_payment_totals(df)) == [("a", 1.0, None)]


def test_sets_are_plain_hash_aggregates(tables):
    for df in (
        order_payment_totals(tables.order_payments),
        reports.payment_method(tables),
        cohorts.cohort_retention(tables),
        cohorts.cohort_activity(tables),
    ):
        assert "ObjectHashAggregate" not in plan(df)
        assert "HashAggregate" in plan(df)


def test_retention_over_three_hundred_years(spark, tables, rows):
    months = [0, 1, 62, 63, 64, 700, 3599]
    moments = [datetime.datetime(1800 + m // 12, m % 12 + 1, 5) for m in months]
    orders = tables.orders.where("order_id = 'o1'").drop("order_id", "order_purchase_timestamp")
    made = spark.createDataFrame(
        [(f"n{k}", moment) for k, moment in enumerate(moments)],
        "order_id string, order_purchase_timestamp timestamp_ntz",
    )
    t = tables.replaced(orders=made.join(orders, F.lit(True)).select(*tables.orders.columns))
    found = cohorts.cohort_retention(t).select("cohort_month", "cohort_index", "active_customers")
    assert rows(found) == [("1800-01", m, 1) for m in months]


def test_no_delivery_gives_no_retention(tables):
    assert cohorts.cohort_retention(tables.replaced(orders=tables.orders.limit(0))).count() == 0


def test_review_averages_do_not_depend_on_the_order_of_rows(spark, tables):
    scores = [(f"r{k}", f"o{k % 3 + 1}", (k * 7) % 5 + 1 if k % 11 else None) for k in range(900)]
    # Orders with one to many reviews: thirds and sevenths do not end as decimals.
    df = spark.createDataFrame(scores, "review_id string, order_id string, review_score bigint")
    found = {
        tuple(
            tuple(row)
            for row in reports.review_quality_by_state(
                tables.replaced(order_reviews=df.repartition(n, F.rand(n)))
            ).collect()
        )
        for n in (1, 2, 5)
    }
    assert len(found) == 1
    assert "settled_round" not in dir(reports)


def test_review_average_is_exact(spark):
    by_state = spark.createDataFrame(
        # Averages 1/3 + 2/3 + 1.5 over three orders; a state without any score.
        [("A", 3, 2, 3, 1), ("A", 2, 1, 3, 0), ("B", 0, 4, None, 0), ("A", 0, 1, None, 1)],
        "customer_state string, scores bigint, orders bigint, points bigint, low int",
    )
    found = {row[0]: tuple(row)[1:] for row in reports.review_quality(by_state).collect()}
    assert found == {"A": (4, 0.83, 0.5), "B": (4, None, 0.0)}
