"""Calendar spine, date shifts and gap filling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LAG_DAYS = 1
FORECAST_DAYS = 1


def reference_day(today: str | dt.date | None = None) -> dt.date:
    """The day the job runs for: the argument, or the current date, resolved once."""
    if today is None:
        return dt.date.today()
    if isinstance(today, dt.date):
        return today
    return dt.date.fromisoformat(today)


def window_bounds(today: str | dt.date | None, period: int) -> tuple[dt.date, dt.date]:
    """First and last day of the look-back window: ``period + 2`` days ending yesterday."""
    day = reference_day(today)
    return day - dt.timedelta(period + LAG_DAYS + FORECAST_DAYS), day - dt.timedelta(1)


def in_window(df: DataFrame, today: str | dt.date | None, period: int) -> DataFrame:
    """Rows dated inside the window. A plain range, so it prunes partitions."""
    start, end = window_bounds(today, period)
    return df.where(F.col("date").between(F.lit(start), F.lit(end)))


def spine(
    series: DataFrame,
    keys: list[str],
    today: str | dt.date | None,
    period: int,
    drop_first: bool = True,
) -> DataFrame:
    """Every (series, day) of the window. The first day only feeds the lag features."""
    start, end = window_bounds(today, period)
    if drop_first:
        start += dt.timedelta(1)
    return days_between(series, keys, start, end)


def days_between(
    series: DataFrame, keys: list[str], start: dt.date, end: dt.date
) -> DataFrame:
    """Every (series, day) from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start), F.lit(end))
    return series.select(*keys).distinct().withColumn("date", F.explode(days))


def shift(df: DataFrame, days: int, column: str = "date") -> DataFrame:
    """Move a date column by a publication lag."""
    return df.withColumn(column, F.date_add(column, days))


def fill(
    df: DataFrame,
    calendar: DataFrame,
    keys: list[str],
    zero: list[str],
    keep_null: list[str] | None = None,
) -> DataFrame:
    """Align to the calendar: missing days become 0, days outside it are dropped.

    Columns in ``keep_null`` (a label, say) stay NULL on missing days.
    """
    columns = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in zero]
    return calendar.join(df, [*keys, "date"], "left").select(
        *keys, "date", *columns, *(keep_null or [])
    )
