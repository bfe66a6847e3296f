"""The tables and the cleaned layer under their names, for queries written in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from basketry.operators.cleaning import (
    cleaned_order_items,
    cleaned_orders,
    order_payment_totals,
)
from basketry.sources.generations import Generations
from basketry.sources.model import MODEL, Tables


def register_views(t: Tables) -> list[str]:
    """Make every relation a temporary view; views stay plans and are never materialised."""
    views = {
        **dict(t.items()),
        "cleaned_orders": cleaned_orders(t.orders),
        "order_payment_totals": order_payment_totals(t.order_payments),
        "cleaned_order_items": cleaned_order_items(t),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def register_catalog(
    spark: SparkSession, tables_dir: str, database: str = "basketry", version: int | None = None
) -> list[str]:
    """Make the stored tables of a load tables of the catalog, with statistics.

    Spark sizes joins by the statistics: rows and bytes of each table, and of key columns the
    distinct values. The tables stay where they are; a later call points to a later load.
    """
    generations = Generations(spark, tables_dir)
    generation = generations.read(version).generation
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, spec in MODEL.items():
        table = f"`{database}`.`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(
            f"{database}.{name}", path=generations.location(generation, name), source="parquet"
        )
        keys = ", ".join(f"`{column}`" for column in spec.key)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {keys}")
    return [f"{database}.{name}" for name in MODEL]
