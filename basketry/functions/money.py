"""Exact money arithmetic on 64-bit integers.

Sums of doubles depend on the order of the rows and sums of wide decimals leave the fast
path of the hash aggregate. Amounts are therefore turned into integers as soon as they are
read: ten-thousandths while the parts of one order are added, cents from then on. Cents in
a bigint reach 9.2e16 currency units, and ANSI mode raises on overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType


def fine_units(df: DataFrame, column: str) -> Column:
    """The amount in ten-thousandths, so that rounding to cents can wait until after a sum."""
    scaled = F.col(column) * 10_000
    if not isinstance(df.schema[column].dataType, DecimalType):
        scaled = F.rint(scaled)
    return scaled.cast("bigint")


def to_cents(fine: Column) -> Column:
    """Ten-thousandths to cents, half away from zero."""
    half = F.when(fine < 0, -50).otherwise(50)
    return F.call_function("div", fine + half, F.lit(100).cast("bigint"))


def amount(cents: Column) -> Column:
    """Cents as the nearest double, the type in which results are published."""
    return cents / F.lit(100.0)
