from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketry.plans import charts, cohorts
from basketry.sources.extracts import read_extracts
from basketry.sources.testdata import open_tables

JANUARY = [("2021-01", 0, 2, 2, 1.0), ("2021-01", 1, 1, 2, 0.5)]


def test_retention(tables, rows):
    assert rows(cohorts.calculate_cohort_retention(tables)) == JANUARY


def test_unpaid_deliveries_count(tables, rows):
    unpaid = tables.replaced(order_payments=tables.order_payments.where("false"))
    assert rows(cohorts.cohort_retention(unpaid)) == JANUARY


def test_several_orders_in_a_month_count_once(spark, extracts, rows):
    extracts.append(
        "orders",
        "o5,c3,delivered,2021-01-30 10:00:00,,2021-02-01 10:00:00,2021-02-08 10:00:00",
    )
    t = read_extracts(spark, str(extracts))
    assert rows(cohorts.cohort_retention(t)) == JANUARY
    assert len(rows(cohorts.purchase_months(t))) == 4


def test_deliveries_without_a_person_are_left_out(spark, extracts, rows):
    extracts.replace("customers", "c2,u1", "c2,")
    t = read_extracts(spark, str(extracts))
    assert rows(cohorts.cohort_retention(t)) == JANUARY[:1]


def test_index_spans_years(spark, extracts, rows):
    extracts.replace("orders", "delivered,2021-02-01 10:00:00", "delivered,2022-03-01 10:00:00")
    t = read_extracts(spark, str(extracts))
    activity = cohorts.cohort_activity(t).where("purchase_month <> cohort_month")
    assert rows(activity) == [("u1", "2022-03", "2021-01", 14)]


def test_empty_input_is_refused(tables):
    nothing = tables.replaced(orders=tables.orders.where("false"))
    with pytest.raises(ValueError, match="No delivered orders"):
        cohorts.calculate_cohort_retention(nothing)


def test_matrix(spark, rows):
    retention = spark.createDataFrame(
        [("2021-01", 0, 1.0), ("2021-01", 3, 0.5), ("2021-02", 0, 1.0), ("2021-02", 1, 0.25)],
        "cohort_month string, cohort_index int, retention_rate double",
    )
    matrix = cohorts.cohort_matrix(retention)
    assert matrix.columns == ["cohort_month", "0", "1", "3"]
    expected = [("2021-01", 1.0, None, 0.5), ("2021-02", 1.0, 0.25, None)]
    assert rows(matrix) == expected
    assert rows(cohorts.cohort_matrix(retention, [0, 1, 3])) == expected
    assert rows(charts.labelled_cohort(retention))[1] == ("2021-01", 3, 0.5, "Jan 2021", "50,0%")


def test_month_one_summary(spark, rows):
    retention = spark.createDataFrame(
        [
            ("2021-01", 1, 100, 0.02),
            ("2021-02", 1, 250, 0.04),
            ("2021-03", 1, 300, 0.09),
            ("2021-03", 2, 300, 0.5),
            ("2021-04", 1, 99, 1.0),
        ],
        "cohort_month string, cohort_index int, cohort_customers bigint, retention_rate double",
    )
    assert rows(cohorts.month_one_summary(retention)) == [(3, 0.02, 0.09, 0.04)]


def test_properties_on_the_test_tables(spark):
    t = open_tables(spark, "/root/testdata/sf0.001")
    retention = cohorts.cohort_retention(t).collect()
    assert len(retention) == 367
    at_start = [row for row in retention if row.cohort_index == 0]
    assert all(row.retention_rate == 1.0 for row in at_start)
    persons = cohorts.cohort_first_month(t).count()
    assert sum(row.cohort_customers for row in at_start) == persons
    months = cohorts.cohort_activity(t).agg(F.count("*")).first()[0]
    assert sum(row.active_customers for row in retention) == months
