from __future__ import annotations

import datetime
import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.plans import rfm
from basketry.sources.extracts import read_extracts
from basketry.sources.testdata import open_tables


def test_person_table(tables, rows):
    found = rfm.calculate_rfm(tables).select(
        "customer_unique_id",
        "recency",
        "frequency",
        "monetary",
        "recency_score",
        "frequency_score",
        "monetary_score",
        "segment",
        "snapshot_date",
    )
    assert rows(found) == [
        ("u1", 1, 2, 35.0, 4, 5, 5, "Champions", "2021-02-02"),
        ("u2", 18, 1, 16.0, 1, 2, 2, "Lost", "2021-02-02"),
    ]


@pytest.mark.parametrize(
    "snapshot", ["2021-03-01", datetime.date(2021, 3, 1), datetime.datetime(2021, 3, 1, 23)]
)
def test_explicit_snapshot(tables, rows, snapshot):
    found = rfm.rfm_customers(tables, snapshot).select(
        "customer_unique_id", "recency", "snapshot_date"
    )
    assert sorted(rows(found)) == [("u1", 28, "2021-03-01"), ("u2", 45, "2021-03-01")]


def test_unpaid_and_undelivered_orders_are_left_out(spark, extracts, rows):
    extracts.replace("order_payments", "o3,1,credit_card,1,16.0\n", "")
    t = read_extracts(spark, str(extracts))
    assert rows(rfm.rfm_customers(t).select("customer_unique_id")) == [("u1",)]


def test_orders_without_a_person_bound_the_snapshot_only(spark, extracts, rows):
    # o2 is the latest purchase; its customer has no person.
    extracts.replace("customers", "c2,u1", "c2,")
    t = read_extracts(spark, str(extracts))
    found = rfm.rfm_customers(t).select(
        "customer_unique_id", "recency", "frequency", "recency_score", "monetary_score"
    )
    assert sorted(rows(found)) == [("u1", 32, 1, 1, 2), ("u2", 18, 1, 4, 5)]
    assert rows(rfm.rfm_snapshot(t)) == [("2021-02-02",)]


def test_null_payments_sum_to_zero(spark, extracts, rows):
    extracts.replace("order_payments", "o3,1,credit_card,1,16.0", "o3,1,credit_card,1,")
    found = rfm.rfm_customers(read_extracts(spark, str(extracts)))
    assert rows(found.where("customer_unique_id = 'u2'").select("monetary")) == [(0.0,)]


def test_empty_input_is_refused(tables):
    unpaid = tables.replaced(order_payments=tables.order_payments.where("false"))
    with pytest.raises(ValueError, match="No delivered orders with payments"):
        rfm.calculate_rfm(unpaid)


def test_segment_precedence_over_all_score_triples(spark):
    triples = list(itertools.product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int")
    segment = rfm.segment_of(F.col("r"), F.col("f"), F.col("m")).alias("segment")
    found = {tuple(row)[:3]: row.segment for row in df.select("r", "f", "m", segment).collect()}
    assert Counter(found.values()) == {
        "Champions": 8,
        "Loyal Customers": 22,
        "Big Spenders": 38,
        "At Risk": 18,
        "Lost": 12,
        "Potential": 27,
    }
    assert found[4, 4, 4] == "Champions"
    assert found[3, 4, 3] == "Loyal Customers"
    assert found[3, 3, 4] == "Big Spenders"
    assert found[2, 3, 3] == "At Risk"
    assert found[2, 2, 3] == "Lost"
    assert found[3, 2, 3] == "Potential"


CONTRACT = "customer_unique_id string, recency int, frequency int, monetary double, segment string"
VALID = [("u1", 1, 1, 10.0, "Potential"), ("u2", 2, 2, 20.0, "Champions")]


@pytest.mark.parametrize(
    ("people", "message"),
    [
        ([*VALID, VALID[0]], "exactly one RFM row"),
        ([VALID[0], ("u2", 2, 2, 20.0, "Unknown")], "unknown segment"),
        ([VALID[0], ("u2", 2, 2, 20.0, None)], "unknown segment"),
        ([VALID[0], ("u2", 2, 2, -1.0, "Lost")], "cannot be negative"),
        ([VALID[0], ("u2", -2, 2, 1.0, "Lost")], "cannot be negative"),
    ],
)
def test_contract_violations(spark, people, message):
    with pytest.raises(ValueError, match=message):
        rfm.validate_rfm(spark.createDataFrame(people, CONTRACT))


def test_contract_accepts_valid_rows_and_names_missing_columns(spark):
    valid = spark.createDataFrame(VALID, CONTRACT)
    rfm.validate_rfm(valid)
    with pytest.raises(ValueError, match="missing columns: monetary, segment"):
        rfm.validate_rfm(valid.drop("monetary", "segment"))


@pytest.fixture(scope="module")
def test_tables(spark):
    return open_tables(spark, "/root/testdata/sf0.001")


def test_segments_of_the_test_tables(test_tables, rows):
    found = rows(rfm.rfm_segments(rfm.rfm_customers(test_tables)))
    assert [(name, customers) for name, customers, _ in found] == [
        ("At Risk", 3),
        ("Big Spenders", 1),
        ("Champions", 13),
        ("Lost", 12),
        ("Loyal Customers", 3),
        ("Potential", 43),
    ]
    assert round(sum(revenue for *_, revenue in found), 2) == 103451785.65


def test_result_does_not_depend_on_row_order(spark, test_tables, rows):
    shuffled = test_tables.replaced(
        orders=test_tables.orders.orderBy(F.desc("order_id")),
        order_payments=test_tables.order_payments.repartition(7, "payment_type"),
    )
    assert rows(rfm.ordered(rfm.rfm_customers(shuffled))) == rows(
        rfm.ordered(rfm.rfm_customers(test_tables))
    )


def test_person_aggregate_is_shuffled_once(test_tables):
    """Scoring and its subquery read the same exchange by person."""
    scored = rfm.rfm_customers(test_tables)
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange [customer_unique_id") >= 2
