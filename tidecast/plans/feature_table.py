"""The flagship plan: every daily source joined on the calendar, one row per series-day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.functions.scoring import up_or_down
from tidecast.operators import calendar, features, influence, sentiment, series

TREND_LAG = 2


@dataclass(frozen=True)
class Inputs:
    """The tables of one run; all carry the series keys and a ``date``."""

    posts: DataFrame
    influencer_posts: DataFrame
    influencers: DataFrame
    close: DataFrame
    trends: DataFrame
    metrics: DataFrame


def build(
    inputs: Inputs,
    keys: list[str],
    today: str | dt.date | None,
    period: int,
    sources: list[str],
    metric_names: list[str],
    influencer_source: str = "twitter_influencers",
) -> DataFrame:
    """Features, close and label per series and day, with the bookkeeping totals.

    Each raw table is aggregated to one row per (series, day) first, with partial sums
    before its shuffle; only those small tables meet in the outer join.
    """

    def recent(df: DataFrame) -> DataFrame:
        return calendar.in_window(df, today, period)

    price = series.up_label(series.log_return(recent(inputs.close), keys), keys)
    texts = sentiment.source_features(recent(inputs.posts), keys, sources)
    interest = calendar.shift(recent(inputs.trends), TREND_LAG)
    network = series.pivot_metrics(recent(inputs.metrics), keys, metric_names)
    weight = influence.score(inputs.influencers, recent(inputs.influencer_posts), keys)
    days = calendar.spine(recent(inputs.close), keys, today, period)
    table = features.build([texts, interest, network, weight, price], days, keys)
    return table.withColumn("influencer_appearances", F.col(f"total_docs_{influencer_source}"))


def forecasts(table: DataFrame, keys: list[str], source: str = "twitter") -> DataFrame:
    """Feature rows with a stand-in probability, the logistic of the day's log return."""
    chance = 1.0 / (1.0 + F.exp(-F.col("price_diff")))
    return table.select(
        *keys,
        "date",
        "close_price",
        "is_price_up",
        chance.alias("p"),
        up_or_down(chance).alias("prediction"),
        F.col(f"total_positive_{source}").alias("positive"),
        F.col(f"total_negative_{source}").alias("negative"),
        "trends",
        F.col("bitcoin_news_score").alias("news_sentiment"),
    )
