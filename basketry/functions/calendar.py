"""Months as running numbers, days as numbers, and rounding of averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def month_number(moment: Column) -> Column:
    """Months since year zero: cheap to group by, and differences are month distances."""
    return F.year(moment) * 12 + F.month(moment) - 1


def month_text(number: Column) -> Column:
    """`yyyy-MM`, rendered on the few grouped rows rather than on every order."""
    year = F.lpad(F.floor(number / 12).cast("string"), 4, "0")
    month = F.lpad((number % 12 + 1).cast("string"), 2, "0")
    return F.concat(year, F.lit("-"), month)


def days_between(start: Column, end: Column) -> Column:
    """Elapsed time in fractional days."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(float(MICROS_PER_DAY))


def exact_ratio(part: Column, whole: Column, digits: int) -> Column:
    """A ratio of whole numbers that are not negative, rounded half away from zero without error."""
    scale = 10**digits
    doubled = (2 * whole).cast("decimal(20,0)")
    above = (part.cast("decimal(20,0)") * (2 * scale)).cast("decimal(30,0)") + whole
    steps = F.call_function("div", above.cast("decimal(38,0)"), F.nullif(doubled, F.lit(0)))
    return steps / F.lit(float(scale))


def half_even(value: Column, digits: int) -> Column:
    """Round a rate half to even."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale
