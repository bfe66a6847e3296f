"""All aggregated results as one deterministic JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from basketry.plans import overview
from basketry.sources.model import Tables

SCHEMA_VERSION = 1


def _plain(df: DataFrame) -> DataFrame:
    """Columns by name; doubles as decimals, which JSON writes without an exponent."""

    def shown(field) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            column = column.cast("decimal(24,4)")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def _records(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """One row holding a result's records, an array in the result's own order.

    Every result is a grouped summary, so the array is as long as the report it publishes.
    The sort keys lead the struct because an array of structs sorts by its first fields.
    """
    keys = [key.alias(f"key{position}") for position, key in enumerate(order)]
    record = F.struct(*[F.col(column) for column in _plain(df).columns])
    keyed = _plain(df).select(F.struct(*keys, record.alias("record")).alias("entry"))
    ordered = F.sort_array(F.collect_list("entry"))
    return keyed.agg(F.transform(ordered, lambda entry: entry["record"]).alias(name))


def _combined(parts: list[DataFrame]) -> Column:
    """One-row results side by side, each as a scalar subquery."""
    return F.struct(*[part.scalar().alias(part.columns[0]) for part in parts])


def _document(
    business: Column, retention: Column, reconciliation: Column, segments: Column
) -> Column:
    """The JSON text; keys are in order at every level."""
    document = F.struct(
        business.alias("business_queries"),
        retention.alias("cohort_retention"),
        reconciliation.alias("revenue_reconciliation"),
        segments.alias("rfm_segments"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
    return F.to_json(document, {"ignoreNullFields": "false"}).alias("analysis_summary")


def analysis_bundle(
    business: dict[str, DataFrame],
    segments: DataFrame,
    retention: DataFrame,
    reconciliation: DataFrame,
) -> DataFrame:
    """The bundle as one row with one JSON column; no person-level rows are in it."""
    # The order of each report, largest first where it ranks by a value.
    orders: dict[str, tuple[Column, ...]] = {
        "monthly_revenue": (F.col("month"),),
        "payment_method": (-F.col("revenue"), F.col("payment_method")),
        "delivery_performance": (F.col("delivery_status"),),
        "delivery_by_state": (-F.col("average_delivery_days"), F.col("customer_state")),
        "review_quality_by_state": (
            -F.col("low_score_rate"),
            -F.col("reviewed_orders"),
            F.col("customer_state"),
        ),
        "revenue_by_category": (-F.col("revenue"), F.col("category_name")),
    }
    reports_part = [
        _records(business[name], name, *orders[name]) for name in sorted(business)
    ]
    totals = _plain(reconciliation)
    one_row = reconciliation.sparkSession.range(1)
    return one_row.select(
        _document(
            _combined(reports_part),
            _records(retention, "rows", F.col("cohort_month"), F.col("cohort_index")).scalar(),
            totals.select(F.struct(*totals.columns)).scalar(),
            _records(segments, "rows", F.col("segment")).scalar(),
        )
    )


def bundle_of(t: Tables) -> DataFrame:
    """The bundle computed straight from the tables, each of which is read once."""
    parts = overview.all_reports(t)
    rows = t.orders.sparkSession.range(1).select(
        *[part.select(F.struct(*part.columns)).scalar().alias(name) for name, part in parts.items()]
    )
    homes = {
        "monthly_revenue": "deliveries",
        "payment_method": "deliveries",
        "delivery_performance": "deliveries",
        "delivery_by_state": "deliveries",
        "review_quality_by_state": "reviews",
        "revenue_by_category": "items",
    }
    business = [F.col(f"{homes[name]}.{name}").alias(name) for name in sorted(homes)]
    return rows.select(
        _document(
            F.struct(*business),
            F.col("retention.cohort_retention"),
            F.col("items.reconciliation"),
            F.col("segments.rfm_segments"),
        )
    )
