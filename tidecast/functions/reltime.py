"""Relative times, loose date texts and localised numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The units in the order they are tried; the first that matches wins,
# so "1 day 2 hours ago" counts hours.
UNITS = ["second", "min", "minute", "hour", "day", "week", "month", "year"]


def as_utc(ts: Column) -> Column:
    """A zone-free timestamp as an instant in UTC, whatever the session zone."""
    return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")


def _interval(unit: str, n: Column) -> Column:
    if unit == "second":
        return F.make_interval(secs=n)
    if unit in ("min", "minute"):
        return F.make_interval(mins=n)
    part = {"hour": "hours", "day": "days", "week": "weeks", "month": "months", "year": "years"}
    return F.make_interval(**{part[unit]: n})


def resolve(scraped_at: Column, text: Column) -> Column:
    """``"3 hours ago"`` to a timestamp; other text is parsed as an absolute time.

    Months and years clamp at the month end. Text that is neither gives NULL.
    """
    tries = []
    for unit in UNITS:
        digits = F.regexp_extract(text, rf"([0-9]+) {unit}s? ago", 1)
        n = digits.try_cast("int")
        tries.append(F.when(digits != "", scraped_at - _interval(unit, n)))
    return F.coalesce(*tries, text.try_cast("timestamp_ntz"))


def year_month(text: Column) -> Column:
    """``struct(year, month)`` of a date text split by ``-``, ``/`` or ``:``."""
    parts = F.split(text, "[-/:]")

    def number(i: int) -> Column:
        return F.trim(F.try_element_at(parts, F.lit(i))).try_cast("int")

    return F.struct(number(1).alias("year"), number(2).alias("month"))


def decimal_comma(text: Column) -> Column:
    """``"12,5"`` to 12.5; NULL if it is not a number."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
