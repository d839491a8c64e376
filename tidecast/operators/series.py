"""Daily value series: prices, metrics, search interest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OFFSET = 0.5


def candle_date(epoch_ms: str) -> Column:
    """UTC day of an epoch-millisecond close time, whatever the session time zone."""
    return F.date_add(F.lit(dt.date(1970, 1, 1)), F.floor(F.col(epoch_ms) / 86_400_000).cast("int"))


def metric_date(epoch_s: str) -> Column:
    """UTC day of an epoch-second metric time."""
    return F.date_add(F.lit(dt.date(1970, 1, 1)), F.floor(F.col(epoch_s) / 86_400).cast("int"))


def daily_close(
    ticks: DataFrame,
    keys: list[str],
    instant: str,
    tie: str | None = None,
    price: str = "close_price",
) -> DataFrame:
    """Last tick per series and day, by an integer ``instant`` and then an integer ``tie``.

    The two are packed into one decimal, which a hash aggregation can hold; a struct would
    make Spark sort all ticks first. Ticks are reduced to one per (series, day) in every
    task before the shuffle.
    """
    order = F.col(instant) if tie is None else _packed(F.col(instant), F.col(tie))
    return ticks.groupBy(*keys, "date").agg(F.max_by(price, order).alias("close_price"))


def _packed(major: Column, minor: Column) -> Column:
    """Lexicographic order of two bigints as one number: major first, minor never carries."""
    shifted = minor.cast("decimal(20,0)") + F.expr("9223372036854775808BD")
    return major.cast("decimal(19,0)") * F.expr("20000000000000000000BD") + shifted


def log_return(df: DataFrame, keys: list[str], price: str = "close_price") -> DataFrame:
    """``price_diff``: log change from the previous day present in the series.

    Windows here run over one row per (series, day), so a partition is bounded by the
    calendar and not by the size of the raw data.
    """
    by_day = Window.partitionBy(*keys).orderBy("date")
    change = F.log((F.col(price) + OFFSET) / (F.lag(price).over(by_day) + OFFSET))
    return df.withColumn("price_diff", change)


def up_label(df: DataFrame, keys: list[str], price: str = "close_price") -> DataFrame:
    """``is_price_up``: does the next day present close higher? NULL on the last day."""
    by_day = Window.partitionBy(*keys).orderBy("date")
    return df.withColumn("is_price_up", F.lead(price).over(by_day) > F.col(price))


def metric_series(points: DataFrame, keys: list[str]) -> DataFrame:
    """Metric points ``(t, v)`` to ``(date, v)``; several points a day are not expected."""
    return points.select(*keys, "metric", metric_date("t").alias("date"), F.col("v").cast("double"))


def pivot_metrics(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One column per metric, as conditional maxima: one shuffle, where pivot takes two."""
    columns = [F.max(F.when(F.col("metric") == m, F.col("v"))).alias(m) for m in metrics]
    return df.groupBy(*keys, "date").agg(*columns)


def in_reference_range(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Rows from the first reference day up to, not including, the day after the last."""
    first = reference.select(F.min("date")).scalar()
    after = reference.select(F.date_add(F.max("date"), 1)).scalar()
    return df.where((F.col("date") >= first) & (F.col("date") < after))


def drop_trailing_zero(df: DataFrame, keys: list[str], value: str = "trends") -> DataFrame:
    """Drop a series' last day if its value is 0: the provider has not filled it yet."""
    last = F.max("date").over(Window.partitionBy(*keys))
    return (
        df.withColumn("_last", last)
        .where(~((F.col("date") == F.col("_last")) & (F.coalesce(F.col(value), F.lit(-1)) == 0)))
        .drop("_last")
    )


def latest(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each series' last row, by a partially combined ``max_by``."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("date")).alias("_row"))
    return rows.select(*keys, "_row.*")
