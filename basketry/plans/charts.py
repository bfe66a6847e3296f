"""The tables behind the six charts, and the same tables with their labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions import labels
from basketry.functions.money import amount

def segment_customers(rfm: DataFrame) -> DataFrame:
    """Persons per segment, largest first."""
    return (
        rfm.groupBy("segment")
        .agg(F.count("*").alias("customers"))
        .orderBy(F.desc("customers"), "segment")
    )


def segment_revenue(rfm: DataFrame) -> DataFrame:
    """Revenue per segment, largest first."""
    cents = F.rint(F.col("monetary") * 100).cast("bigint")
    return (
        rfm.groupBy("segment")
        .agg(amount(F.sum(cents)).alias("monetary"))
        .orderBy(F.desc("monetary"), "segment")
    )


def bars(table: DataFrame, category: str, value: str) -> DataFrame:
    """A chart table reduced to its two columns."""
    return table.select(category, value)


def value_label(column: str) -> Column:
    """The text on a bar: money compact, days with one decimal, counts in full."""
    value = F.col(column)
    if column in ("revenue", "monetary"):
        return labels.brl_compact(value)
    if column == "average_delivery_days":
        return labels.days(value)
    return labels.integer(value)


def labelled(table: DataFrame, category: str, value: str) -> DataFrame:
    """A chart table with the readable category and the text on the bar."""
    return table.select(
        category,
        value,
        labels.readable(F.col(category)).alias("category_label"),
        value_label(value).alias("value_label"),
    )


def labelled_cohort(retention: DataFrame) -> DataFrame:
    """Retention cells with the cohort's readable month and the rate as a percentage."""
    return retention.select(
        "cohort_month",
        "cohort_index",
        "retention_rate",
        labels.readable(F.col("cohort_month")).alias("cohort_label"),
        labels.percent(F.col("retention_rate")).alias("rate_label"),
    )
