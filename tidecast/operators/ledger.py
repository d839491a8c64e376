"""The prediction ledger: scoring, appending, current state and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions.scoring import outcome, up_or_down
from tidecast.operators.calendar import in_window, shift
from tidecast.operators.series import latest
from tidecast.sources.writers import insert_if_absent, upsert

POSTED_AT = "07:00:00"


def score_next(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Score each prediction against the next price of its series."""
    by_day = Window.partitionBy(*keys).orderBy("date")
    change = F.lead("close_price").over(by_day) - F.col("close_price")
    return predictions.withColumn("price_diff", change).withColumn(
        "outcome", outcome(F.col("price_diff"), F.col("prediction"))
    )


def last_prediction(prices: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """As-of join: each price with the last prediction made on an earlier day.

    Both tables hold one row per series and day. They are stacked and the last non-null
    prediction is carried forward, so every series is sorted once and nothing is
    matched pair by pair.
    """
    price_rows = prices.select(*keys, "date", "close_price", F.lit(0).alias("_kind"))
    made = F.struct(F.col("close_price").alias("price"), "prediction")
    made_rows = predictions.select(*keys, "date", made.alias("_made"), F.lit(1).alias("_kind"))
    order = Window.partitionBy(*keys).orderBy("date", "_kind")
    carried = F.last("_made", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, -1)
    )
    stacked = price_rows.unionByName(made_rows, allowMissingColumns=True)
    return (
        stacked.withColumn("_last", carried)
        .where(F.col("_kind") == 0)
        .select(
            *keys,
            "date",
            "close_price",
            F.col("_last.price").alias("last_price"),
            F.col("_last.prediction").alias("last_prediction"),
        )
    )


def outcomes(prices: DataFrame, predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Ledger rows: posting time, price, day of month, change, Correct/Wrong."""
    rows = last_prediction(prices, predictions, keys)
    change = F.col("close_price") - F.col("last_price")
    return rows.select(
        *keys,
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(f" {POSTED_AT}")).alias("datetime"),
        F.col("close_price").alias("price"),
        F.day("date").alias("day"),
        change.alias("price_diff"),
        outcome(change, F.col("last_prediction")).alias("outcome"),
    )


def append(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The ledger after adding rows whose posting time is not in it yet."""
    return insert_if_absent(new, existing, [*keys, "datetime"])


def current(forecasts: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    """One row per series: the newest forecast, stated for the day it is about.

    A series already stored for the same target day keeps its row.
    """
    newest = latest(forecasts, keys).select(
        *keys,
        F.date_format(F.date_add("date", 1), "dd/MM/yyyy").alias("target_date"),
        F.col("close_price").alias("reference_price"),
        "prediction",
        "positive",
        "negative",
        "trends",
    )
    if existing is None:
        return newest
    stored = existing.select(*keys, F.col("target_date").alias("_stored"))
    changed = (
        newest.join(stored, keys, "left")
        .where(F.col("_stored").isNull() | (F.col("_stored") != F.col("target_date")))
        .drop("_stored")
    )
    return upsert(changed, existing, keys)


def history(forecasts: DataFrame, keys: list[str]) -> DataFrame:
    """Append-only history of forecasts, stamped for the next day at the posting time."""
    stamp = F.concat(
        F.date_format(F.date_add("date", 1), "yyyy-MM-dd"), F.lit(f" {POSTED_AT}")
    )
    return forecasts.select(
        *keys,
        stamp.alias("predicted_for"),
        "p",
        "prediction",
        "positive",
        "negative",
        "trends",
        "news_sentiment",
    )


def sentiment_history(
    totals: DataFrame, keys: list[str], test_date: dt.date, n_days: int = 7
) -> DataFrame:
    """Positive and negative totals of the last ``n_days``, dated one day later."""
    recent = in_window(totals, test_date + dt.timedelta(1), n_days - 2)
    return shift(recent, 1).select(
        *keys, F.date_format("date", "yyyy-MM-dd").alias("date"), "total_positive", "total_negative"
    )


def trend_history(
    trends: DataFrame, keys: list[str], test_date: dt.date, n_days: int = 7
) -> DataFrame:
    """Recent search interest, rounded half to even, over ``n_days + 2`` days."""
    recent = in_window(trends, test_date + dt.timedelta(1), n_days)
    return recent.select(
        *keys,
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.bround("trends").cast("long").alias("trends"),
    )


def record(
    last_rows: DataFrame,
    metrics: DataFrame,
    keys: list[str],
    selected: list[str],
    threshold: float = 0.5,
) -> DataFrame:
    """The published prediction record, one row per series.

    ``last_rows`` holds each series' last feature row with the probability ``p``;
    ``metrics`` the evaluation results per series.
    """
    rows = last_rows.select(
        *keys,
        F.col("date").alias("utc_date"),
        F.date_add("date", 1).alias("date"),
        F.col("close_price").alias("reference_price"),
        F.bround("p", 2).alias("tomorrow_price_up_prob"),
        up_or_down(F.col("p"), threshold).alias("tomorrow_prediction"),
        F.col("positive").cast("long").alias("twitter_positive_sentiment"),
        F.col("negative").cast("long").alias("twitter_negative_sentiment"),
        F.bround("news_sentiment", 2).alias("news_sentiment"),
        F.bround("trends").cast("long").alias("google_trends"),
        F.array(*[F.lit(c) for c in selected]).alias("selected_features"),
    )
    return rows.join(metrics, keys, "left")
