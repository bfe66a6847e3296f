"""Monthly cohort retention of persons with clean deliveries, paid or not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from basketry.functions.calendar import half_even, month_number, month_text
from basketry.operators.bits import bit_words, members, word_names
from basketry.operators.cleaning import PURCHASED, clean_deliveries
from basketry.sources.model import Tables

# Smallest cohort whose month-one rate is representative in the summary.
REPRESENTATIVE_COHORT = 100


def purchase_months(t: Tables) -> DataFrame:
    """Person and purchase month of every clean delivery."""
    return (
        clean_deliveries(t)
        .select("customer_id", PURCHASED)
        .join(t.customers.select("customer_id", "customer_unique_id"), "customer_id")
        .select(
            "customer_unique_id",
            F.date_format(PURCHASED, "yyyy-MM").alias("purchase_month"),
        )
    )


def month_span(t: Tables) -> tuple[int, int]:
    """The first month with a clean delivery, and how many months there are to the last one."""
    month = month_number(F.col(PURCHASED))
    found = clean_deliveries(t).agg(F.min(month).alias("first"), F.max(month).alias("last")).first()
    return (0, 0) if found.first is None else (found.first, found.last - found.first + 1)


def months_of(rows: DataFrame, key: str, span: tuple[int, int]) -> DataFrame:
    """The months of each key as bits over the span, from (key, month) rows."""
    names = word_names("months", span[1])
    words = bit_words(F.col("month") - span[0], span[1])
    coded = rows.select(key, *[word.alias(name) for word, name in zip(words, names)])
    return merged_months(coded, key, span)


def merged_months(coded: DataFrame, key: str, span: tuple[int, int]) -> DataFrame:
    return coded.groupBy(key).agg(
        *[F.bit_or(name).alias(name) for name in word_names("months", span[1])]
    )


def active_months(coded: DataFrame, span: tuple[int, int]) -> DataFrame:
    """(customer_unique_id, cohort, months) of persons with their months as bits."""
    words = [F.col(name) for name in word_names("months", span[1])]
    months = F.transform(members(words, span[1]), lambda at: at + span[0])
    return coded.select("customer_unique_id", months.alias("months")).select(
        "customer_unique_id", F.get("months", F.lit(0)).alias("cohort"), "months"
    )


def _months_by_person(t: Tables) -> DataFrame:
    """Distinct active months of each person, and the first of them.

    Months are bits over the span of all months, one word for each 63, so that neither a customer
    id nor a person with a large share of the orders makes a large group; both groupings combine on
    the map side in buffers of fixed size.
    """
    span = month_span(t)
    by_customer = months_of(
        clean_deliveries(t).select("customer_id", month_number(F.col(PURCHASED)).alias("month")),
        "customer_id",
        span,
    )
    persons = t.customers.select("customer_id", "customer_unique_id").where(
        F.col("customer_unique_id").isNotNull()
    )
    joined = by_customer.join(persons, "customer_id")
    return active_months(merged_months(joined, "customer_unique_id", span), span)


def _activity(t: Tables) -> DataFrame:
    return _months_by_person(t).select(
        "customer_unique_id", "cohort", F.explode("months").alias("month")
    )


def cohort_activity(t: Tables) -> DataFrame:
    """Every active month of a person with the person's first month and the distance to it."""
    return _activity(t).select(
        "customer_unique_id",
        month_text(F.col("month")).alias("purchase_month"),
        month_text(F.col("cohort")).alias("cohort_month"),
        (F.col("month") - F.col("cohort")).alias("cohort_index"),
    )


def cohort_first_month(t: Tables) -> DataFrame:
    """First active month per person."""
    return _months_by_person(t).select(
        "customer_unique_id", month_text(F.col("cohort")).alias("cohort_month")
    )


def cohort_sizes(t: Tables) -> DataFrame:
    """Persons per cohort."""
    return (
        _months_by_person(t)
        .groupBy("cohort")
        .agg(F.count("*").alias("cohort_customers"))
        .select(month_text(F.col("cohort")).alias("cohort_month"), "cohort_customers")
        .orderBy("cohort_month")
    )


def cohort_retention(t: Tables) -> DataFrame:
    """Active persons and retention rate per cohort and month distance."""
    return retention_of(_months_by_person(t))


def retention_of(persons: DataFrame) -> DataFrame:
    """The retention of persons with their months (see :func:`active_months`).

    Everyone is active in the first month, so the cohort's size is its count at distance
    zero. The window runs over counts, at most one per pair of calendar months.
    """
    counts = (
        persons.select("cohort", F.explode("months").alias("month"))
        .groupBy("cohort", (F.col("month") - F.col("cohort")).alias("cohort_index"))
        .agg(F.count("*").alias("active_customers"))
    )
    at_start = F.when(F.col("cohort_index") == 0, F.col("active_customers"))
    size = F.max(at_start).over(Window.partitionBy("cohort"))
    sized = counts.withColumn("cohort_customers", size)
    rate = F.col("active_customers") / F.col("cohort_customers")
    return sized.select(
        month_text(F.col("cohort")).alias("cohort_month"),
        "cohort_index",
        "active_customers",
        "cohort_customers",
        half_even(rate, 4).alias("retention_rate"),
    ).orderBy("cohort_month", "cohort_index")


def _require_rows(orders: DataFrame) -> None:
    if orders.isEmpty():
        raise ValueError("No delivered orders are available for cohort analysis")


def require_deliveries(t: Tables) -> None:
    """Refuse an input without a clean delivery; reads no further than the first one."""
    _require_rows(clean_deliveries(t))


def calculate_cohort_retention(t: Tables) -> DataFrame:
    """Retention, refusing an input without a clean delivery of a known person."""
    _require_rows(purchase_months(t).where(F.col("customer_unique_id").isNotNull()))
    return cohort_retention(t)


def observed_indexes(retention: DataFrame) -> list[int]:
    """The month distances that occur: one whole number per column of the matrix."""
    rows = retention.select("cohort_index").distinct().orderBy("cohort_index").collect()
    return [row.cohort_index for row in rows]


def cohort_grid(retention: DataFrame) -> DataFrame:
    """A row for each cohort and each distance that any cohort has; null where it has none.

    The window runs over retention rows, at most one per pair of calendar months.
    """
    distances = F.collect_set("cohort_index").over(Window.partitionBy())
    rates = F.map_from_entries(F.collect_list(F.struct("cohort_index", "retention_rate")))
    return (
        retention.withColumn("distances", distances)
        .groupBy("cohort_month")
        .agg(F.first("distances").alias("distances"), rates.alias("rates"))
        .select("cohort_month", "rates", F.explode("distances").alias("cohort_index"))
        .select(
            "cohort_month",
            "cohort_index",
            F.try_element_at("rates", "cohort_index").alias("retention_rate"),
        )
        .orderBy("cohort_month", "cohort_index")
    )


def cohort_matrix(retention: DataFrame, indexes: Sequence[int] | None = None) -> DataFrame:
    """Cohorts by month distance; null where no activity was observed.

    The columns are values of the data: the retention, best a stored table, is read once to
    find them and once to pivot; naming the indexes saves the former.
    """
    if indexes is None:
        indexes = observed_indexes(retention)
    return (
        retention.groupBy("cohort_month")
        .pivot("cohort_index", list(indexes))
        .agg(F.first("retention_rate"))
        .orderBy("cohort_month")
    )


def month_one_summary(
    retention: DataFrame, smallest: int = REPRESENTATIVE_COHORT
) -> DataFrame:
    """Lowest, highest and median month-one rate over representative cohorts."""
    month_one = retention.where(
        (F.col("cohort_index") == 1) & (F.col("cohort_customers") >= smallest)
    )
    return month_one.agg(
        F.count("*").alias("cohorts"),
        F.min("retention_rate").alias("lowest_rate"),
        F.max("retention_rate").alias("highest_rate"),
        F.median("retention_rate").alias("median_rate"),
    )
