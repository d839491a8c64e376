"""The daily job: texts to sentiment records, features to a forecast, forecast to ledger.

Series and day are grouping keys throughout, so the same plan runs one day or a backfill
of every day.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions import text
from tidecast.operators import calendar, checks, features, folds, ledger, model, sentiment, series
from tidecast.session import scratch_dir
from tidecast.sources import versions, writers

RowFilter = Callable[[DataFrame], DataFrame]


def extract_sentiment(
    articles: DataFrame,
    keys: list[str],
    row_id: str,
    relevant: RowFilter,
    classify: RowFilter,
    untitled: list[str] | None = None,
    sample_size: int | None = None,
) -> DataFrame:
    """Daily sentiment records of every source and day.

    ``relevant`` keeps the rows worth classifying; ``classify`` returns one row per text
    and aspect with its ``polarity``. All texts are classified unless ``sample_size`` bounds
    their number per source and day. The document count is of all texts; a day without
    relevant texts has no record. A row without a date raises before anything is classified.
    """
    checks.require_dates(articles, "date")
    totals = articles.groupBy(*keys, "date").agg(F.count("*").alias("total_docs"))
    texts = sentiment.content(articles, untitled).select(row_id, *keys, "date", "content")
    if sample_size is not None:
        texts = sentiment.sample_per_day(texts, keys, sample_size, row_id)
    cleaned = texts.withColumn("content", text.normalize(F.col("content")))
    found = sentiment.records(classify(relevant(cleaned)), keys).drop("total_docs")
    return found.join(totals, [*keys, "date"])


@dataclass(frozen=True)
class Settings:
    """Periods in days and the parameter sets to try.

    ``params_path`` keeps the chosen parameters; a later day passes them as its only
    candidate (``model.load_params``) and so does not search again.
    """

    train_days: int
    holdout_days: int = 14
    selection_gap: int = 60
    step: int = 1
    n_features: int = 10
    threshold: float = 0.5
    selector: model.Params = model.Params()
    candidates: list[model.Params] = field(default_factory=lambda: model.draw_params(20))
    params_path: str | None = None


def forecast(table: DataFrame, keys: list[str], settings: Settings) -> DataFrame:
    """Select features, tune, evaluate, fit and predict: one prediction record per series.

    ``table`` is the full feature table with its totals. It is written once, because the
    fits pass over it many times. The last day of each series is what is predicted; its
    label is unknown, so it takes no part in selection, tuning or training.
    """
    spark = table.sparkSession
    path = scratch_dir(spark, "forecast")
    table.write.parquet(path)
    stored = spark.read.parquet(path)
    first, last = folds.date_bounds(stored)
    days = calendar.days_between(stored, keys, first, last)
    checks.require_daily_cardinality(stored, days, keys)
    known = stored.where(F.col("date") < F.lit(last))
    ranked = model.top_features(
        known,
        keys,
        features.feature_columns(stored, keys),
        settings.n_features,
        settings.selection_gap,
        settings.selector,
    )
    selected = [row["feature"] for row in ranked.collect()]
    evaluated = model.evaluate_model(
        known,
        keys,
        selected,
        settings.train_days,
        settings.holdout_days,
        settings.step,
        settings.candidates,
    )
    if settings.params_path:
        model.save_params(spark, evaluated.best, settings.params_path)
    fitted = model.fit(known, selected, evaluated.best)
    rows = series.latest(stored.where(F.col("date") == F.lit(last)), keys)
    scored = model.predict(fitted, rows, selected)
    shown = scored.select(
        *keys,
        "date",
        "close_price",
        "p",
        F.col("total_positive_twitter").alias("positive"),
        F.col("total_negative_twitter").alias("negative"),
        F.col("bitcoin_news_score").alias("news_sentiment"),
        "trends",
    )
    return ledger.record(shown, evaluated.metrics, keys, selected, settings.threshold)


@dataclass(frozen=True)
class Ledger:
    """The four published tables."""

    results: DataFrame
    current: DataFrame
    sentiment: DataFrame
    trends: DataFrame


def update_ledger(
    record: DataFrame,
    stored: Ledger,
    totals: DataFrame,
    trends: DataFrame,
    keys: list[str],
) -> Ledger:
    """The ledger after a run: score the stored forecast, replace it, refresh the reports."""
    made = stored.current.select(
        *keys,
        F.date_sub(F.to_date("target_date", "dd/MM/yyyy"), 1).alias("date"),
        F.col("reference_price").alias("close_price"),
        "prediction",
    )
    prices = record.select(*keys, "date", F.col("reference_price").alias("close_price"))
    forecasts = record.select(
        *keys,
        "date",
        F.col("reference_price").alias("close_price"),
        F.col("tomorrow_prediction").alias("prediction"),
        F.col("twitter_positive_sentiment").alias("positive"),
        F.col("twitter_negative_sentiment").alias("negative"),
        F.col("google_trends").alias("trends"),
    )
    test_date = record.agg(F.max("utc_date")).first()[0]
    return Ledger(
        results=ledger.append(ledger.outcomes(prices, made, keys), stored.results, keys),
        current=ledger.current(forecasts, stored.current, keys),
        sentiment=ledger.sentiment_history(totals, keys, test_date),
        trends=ledger.trend_history(trends, keys, test_date),
    )


def publish(spark: SparkSession, updated: Ledger, record: DataFrame, root: str, version: int) -> None:
    """Publish the ledger tables and the record as one version."""
    tables = {
        "results": updated.results,
        "current": updated.current,
        "sentiment": updated.sentiment,
        "trends": updated.trends,
        "records": record,
    }
    writers.publish(spark, tables, root, version)


def publish_day(record: DataFrame, totals: DataFrame, trends: DataFrame, keys: list[str], root: str) -> versions.Version:
    """One day into the versioned ledger at ``root``: score what was forecast, keep the new forecast, refresh the reports.

    ``results`` and ``records`` grow by the rows that are not there yet, so a day that is run again
    adds none; ``current``, ``sentiment`` and ``trends`` are replaced. A price without an earlier
    forecast has nothing to score. Of two runs at once, one raises ``versions.VersionTaken`` and
    has changed nothing.
    """
    spark = record.sparkSession
    base = versions.load(spark, root)
    stored = versions.tables(spark, root, base)
    path = scratch_dir(spark, "record")
    record.write.parquet(path)
    record = spark.read.parquet(path)
    before = {**_first_tables(record, keys), **stored}
    results = before["results"]
    updated = update_ledger(record, Ledger(results, before["current"], before["sentiment"], before["trends"]), totals, trends, keys)
    scored = updated.results.where(F.col("price_diff").isNotNull()).join(results, [*keys, "datetime"], "left_anti")
    fresh = record
    if "records" in stored:
        fresh = record.join(stored["records"], [*keys, "utc_date"], "left_anti").select(record.columns)
    return versions.commit(
        spark,
        root,
        {
            "results": versions.Change(scored.select(results.columns), append="results" in stored),
            "records": versions.Change(fresh, append="records" in stored),
            "current": versions.Change(updated.current),
            "sentiment": versions.Change(updated.sentiment),
            "trends": versions.Change(updated.trends),
        },
        base,
    )


def _first_tables(record: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    """The empty tables of a ledger that nothing was published to."""
    spark = record.sparkSession
    own = {f.name: f.dataType.simpleString() for f in record.schema.fields}
    series = ", ".join(f"`{k}` {own[k]}" for k in keys)
    price, count, trends = own["reference_price"], own["twitter_positive_sentiment"], own["google_trends"]
    schemas = {
        "results": f"{series}, datetime string, price {price}, day int, price_diff {price}, outcome string",
        "current": f"{series}, target_date string, reference_price {price}, prediction string, positive {count}, negative {count}, trends {trends}",
        "sentiment": f"{series}, date string, total_positive long, total_negative long",
        "trends": f"{series}, date string, trends long",
    }
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.items()}


def run_day(
    table: DataFrame, totals: DataFrame, trends: DataFrame, keys: list[str], settings: Settings, root: str
) -> versions.Version:
    """A whole day: forecast from the feature table, then publish. It can be run again, alone or beside another run."""
    return publish_day(forecast(table, keys, settings), totals, trends, keys, root)
