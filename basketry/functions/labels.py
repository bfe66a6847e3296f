"""Readable labels in Brazilian notation, built from Spark string functions.

`format_number` rounds half to even on the exact value of the double.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def brazilian_number(value: Column, decimals: int) -> Column:
    """Point for thousands, comma for decimals."""
    return F.translate(F.format_number(value, decimals), ",.", ".,")


def brl(value: Column, decimals: int = 2) -> Column:
    """`R$ 15.421.082,85`; the sign of a negative amount follows the unit."""
    return F.concat(F.lit("R$ "), brazilian_number(value, decimals))


def percent(value: Column, decimals: int = 1) -> Column:
    """A fraction as a percentage: 0.25 is `25,0%`."""
    return F.concat(brazilian_number(value * 100, decimals), F.lit("%"))


def integer(value: Column) -> Column:
    """A count with thousands separators: `58.673`."""
    return brazilian_number(value, 0)


def _scaled_brl(value: Column, thousands_decimals: int, plain_decimals: int) -> Column:
    millions = F.concat(brl(value / 1_000_000, 1), F.lit("M"))
    thousands = F.concat(brl(value / 1_000, thousands_decimals), F.lit("k"))
    return (
        F.when(F.abs(value) >= 1_000_000, millions)
        .when(F.abs(value) >= 1_000, thousands)
        .otherwise(brl(value, plain_decimals))
    )


def brl_compact(value: Column) -> Column:
    """`R$ 15,4M`, `R$ 15,4k` or the full amount: the label of a bar."""
    return _scaled_brl(value, thousands_decimals=1, plain_decimals=2)


def brl_tick(value: Column) -> Column:
    """The coarser form for axis ticks: whole thousands and whole units."""
    return _scaled_brl(value, thousands_decimals=0, plain_decimals=0)


def days(value: Column) -> Column:
    """`29.4 d`, with a decimal point."""
    digits = F.translate(F.format_number(value, 1), ",", "")
    return F.concat(digits, F.lit(" d"))


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _title(text: Column) -> Column:
    """A capital after every non-letter; `initcap` alone starts words only after a space."""
    words = F.transform(F.split(text, r"(?<=\P{L})"), F.initcap)
    return F.array_join(words, "")


def readable(label: Column) -> Column:
    """Month as `Jan 2021`, state codes unchanged, method lists as `Credit Card + Voucher`."""
    text = _stripped(label)
    month = F.date_format(F.try_to_date(F.concat(text, F.lit("-01"))), "MMM yyyy")
    parts = F.transform(
        F.split(text, ","),
        lambda part: _title(F.translate(_stripped(part), "_", " ")),
    )
    return (
        F.when(text.rlike("^[0-9]{4}-[0-9]{2}$"), F.coalesce(month, text))
        .when(text.rlike("^[A-Z]{2}$"), text)
        .otherwise(F.array_join(parts, " + "))
    )
