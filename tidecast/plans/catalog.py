"""Named queries: every operator applied to whole tables.

A query takes a session and the folder of the input tables and returns a DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast import fixtures as fx
from tidecast.functions import markup, reltime, scoring, text
from tidecast.operators import (
    asof,
    calendar,
    checks,
    evaluate,
    features,
    folds,
    influence,
    ledger,
    model,
    network,
    pieces,
    sentiment,
    series,
    skew,
    social,
)
from tidecast.plans import daily_job
from tidecast.plans import feature_table as flagship
from tidecast.plans.stumps import STUMP_CUTS, STUMP_FEATURES, STUMP_SETTINGS
from tidecast.session import scratch_dir
from tidecast.sources import daily, merge, pages, versions, writers
from tidecast.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEY = ["series_id"]
TODAY, PERIOD = dt.date(2024, 1, 31), 27
LONG_TODAY, LONG_PERIOD = dt.date(2001, 8, 2), 2000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Fixed digits for comparison; adding 0.0 turns a negative zero into zero."""
    fixed = {c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns}
    return df.withColumns(fixed)


# Features -----------------------------------------------------------------------


def _full_table(spark: SparkSession, d: str) -> DataFrame:
    posts = fx.posts(spark, d)
    inputs = flagship.Inputs(
        posts=posts,
        influencer_posts=posts.where(F.col("media") == "twitter_influencers"),
        influencers=fx.influencers(spark, d),
        close=fx.close(spark, d),
        trends=fx.trends(spark, d),
        metrics=fx.metric_points(spark, d),
    )
    return flagship.build(inputs, KEY, TODAY, PERIOD, fx.SOURCES, fx.METRICS)


@query
def feature_table(spark: SparkSession, d: str) -> DataFrame:
    table = features.drop_non_features(_full_table(spark, d))
    doubles = [f.name for f in table.schema if f.dataType.typeName() == "double"]
    return _rounded(table, *doubles)


@query
def calendar_fill(spark: SparkSession, d: str) -> DataFrame:
    prices = fx.prices(spark, d)
    days = calendar.spine(prices, KEY, LONG_TODAY, LONG_PERIOD)
    return calendar.fill(prices, days, KEY, ["close_price"])


@query
def calendar_spine(spark: SparkSession, d: str) -> DataFrame:
    return calendar.spine(fx.prices(spark, d), KEY, LONG_TODAY, LONG_PERIOD, drop_first=False)


@query
def date_shift(spark: SparkSession, d: str) -> DataFrame:
    return calendar.shift(fx.trends(spark, d), flagship.TREND_LAG)


@query
def latest_row(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(series.latest(series.log_return(fx.prices(spark, d), KEY), KEY), "price_diff")


@query
def union_sources(spark: SparkSession, d: str) -> DataFrame:
    totals = sentiment.polarity_totals(fx.posts(spark, d), KEY)
    zero = ["total_positive", "total_negative", "total_none", "trends"]
    return features.union_sources([totals, fx.trends(spark, d)], zero)


# Price, metric and interest series -----------------------------------------------


@query
def daily_close(spark: SparkSession, d: str) -> DataFrame:
    candles = fx.ticks(spark, d).withColumn("date", series.candle_date("closetime"))
    return series.daily_close(candles, KEY, "closetime", "event_id")


@query
def log_return(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(series.log_return(fx.prices(spark, d), KEY), "price_diff")


@query
def up_label(spark: SparkSession, d: str) -> DataFrame:
    return series.up_label(fx.prices(spark, d), KEY)


@query
def metric_range_filter(spark: SparkSession, d: str) -> DataFrame:
    reference = calendar.in_window(fx.close(spark, d), dt.date(2024, 1, 21), 14)
    return series.in_reference_range(fx.metric_points(spark, d), reference)


@query
def metric_pivot(spark: SparkSession, d: str) -> DataFrame:
    points = series.metric_series(fx.event_metrics(spark, d), [])
    return series.pivot_metrics(points, [], fx.EVENT_METRICS)


@query
def drop_trailing_zero(spark: SparkSession, d: str) -> DataFrame:
    return series.drop_trailing_zero(fx.trends(spark, d), KEY)


# Sentiment ----------------------------------------------------------------------


@query
def aspect_polarity_count(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.counts(fx.posts(spark, d), KEY)


@query
def polarity_totals(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.polarity_totals(fx.posts(spark, d), KEY)


@query
def polarity_score(spark: SparkSession, d: str) -> DataFrame:
    totals = sentiment.polarity_totals(fx.posts(spark, d), KEY)
    counted = [F.col(f"total_{p.lower()}") for p in scoring.POLARITIES]
    scored = totals.select(*KEY, "date", scoring.polarity_score(*counted).alias("score"))
    return _rounded(scored, "score")


@query
def pos_neg_ratio(spark: SparkSession, d: str) -> DataFrame:
    totals = sentiment.polarity_totals(fx.posts(spark, d), KEY)
    ratio = scoring.pos_neg_ratio(F.col("total_positive"), F.col("total_negative"))
    return _rounded(totals.select(*KEY, "date", ratio.alias("ratio")), "ratio")


@query
def docs_per_day(spark: SparkSession, d: str) -> DataFrame:
    return fx.articles(spark, d).groupBy("media", "date").agg(F.count("*").alias("total_docs"))


def _stored_records(spark: SparkSession, d: str) -> str:
    path = scratch_dir(spark, "records")
    records = sentiment.records(fx.posts(spark, d), ["media"])
    writers.write_daily(records, path, fmt="json", dedup=False)
    return path


@query
def sentiment_record(spark: SparkSession, d: str) -> DataFrame:
    stored = daily.read(spark, _stored_records(spark, d), daily.SENTIMENT_SCHEMA)
    return sentiment.flatten_records(stored, ["media"], ["total_docs"])


@query
def scan_window_json(spark: SparkSession, d: str) -> DataFrame:
    start, end = calendar.window_bounds(dt.date(2024, 1, 21), 7)
    stored = daily.read(spark, _stored_records(spark, d), daily.SENTIMENT_SCHEMA, start, end)
    return sentiment.polarity_totals(
        sentiment.flatten_records(stored, ["media"]), ["media"], weight="n"
    )


@query
def build_content(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.content(fx.articles(spark, d), untitled=["twitter"]).select("doc_id", "content")


@query
def sample_n_per_day(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.posts(spark, d).select("event_id", "media", "date")
    return sentiment.sample_per_day(rows, ["media"], 20, "event_id")


@query
def aspect_expand(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.articles(spark, d).select("doc_id")
    return sentiment.expand_aspects(rows)


@query
def argmax_label(spark: SparkSession, d: str) -> DataFrame:
    label = scoring.argmax_label(F.col("probabilities"), scoring.POLARITIES)
    return fx.class_probabilities(spark, d).select("event_id", label.alias("polarity"))


@query
def lexicon_polarity(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.words(fx.articles(spark, d))
    return sentiment.lexicon_polarity(rows, ["doc_id"], fx.lexicon(spark))


@query
def sentiment_extraction(spark: SparkSession, d: str) -> DataFrame:
    def relevant(rows: DataFrame) -> DataFrame:
        return rows.where(F.contains(F.lower("content"), F.lit("the")))

    def classified(rows: DataFrame) -> DataFrame:
        return sentiment.lexicon_polarity(rows, ["doc_id", "media", "date"], fx.lexicon(spark))

    records = daily_job.extract_sentiment(
        fx.articles(spark, d), ["media"], "doc_id", relevant, classified, ["twitter"]
    )
    return sentiment.flatten_records(records, ["media"], ["total_docs"])


# Influence ----------------------------------------------------------------------


@query
def top_influencers(spark: SparkSession, d: str) -> DataFrame:
    return influence.top(fx.influencers(spark, d), 20, per=["token"])


@query
def influence_join(spark: SparkSession, d: str) -> DataFrame:
    joined = influence.posts_with_rank(fx.influencers(spark, d), fx.order_posts(spark, d))
    return joined.select("tweet_id", "date", F.col("author").alias("handle"), "rank")


@query
def posts_by_influencers(spark: SparkSession, d: str) -> DataFrame:
    listed = influence.top(fx.influencers(spark, d), 300)
    return social.by_authors(fx.order_posts(spark, d), listed)


@query
def influence_score(spark: SparkSession, d: str) -> DataFrame:
    scored = influence.score(fx.influencers(spark, d), fx.order_posts(spark, d), KEY)
    return _rounded(scored, "influence_score", digits=4)


# Posts --------------------------------------------------------------------------


def _stored_pages(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "pages")
    pages.dump(fx.pages_json(spark, d), path)
    return pages.read(spark, path)


@query
def flatten_pages(spark: SparkSession, d: str) -> DataFrame:
    posts, users, places = pages.flatten(_stored_pages(spark, d))
    kinds = [
        posts.select(F.lit("post").alias("kind"), F.col("tweet_id").alias("id"), "article"),
        users.select(F.lit("user").alias("kind"), "id", F.col("username").alias("article")),
        places.select(F.lit("place").alias("kind"), "id", F.col("full_name").alias("article")),
    ]
    return features.union_sources(kinds)


@query
def post_type(spark: SparkSession, d: str) -> DataFrame:
    posts = pages.posts(pages.parse(fx.pages_json(spark, d)))
    return posts.select("tweet_id", "tweet_type", "geo_id")


@query
def expand_metrics(spark: SparkSession, d: str) -> DataFrame:
    posts = pages.posts(pages.parse(fx.pages_json(spark, d)))
    return social.expand_metrics(posts.select("tweet_id", "public_metrics"))


@query
def enrich_author(spark: SparkSession, d: str) -> DataFrame:
    posts, users, _ = pages.flatten(_stored_pages(spark, d))
    rows = social.with_author(posts, users)
    return rows.select("tweet_id", "author_id", "username_source")


@query
def enrich_reply_target(spark: SparkSession, d: str) -> DataFrame:
    posts, users, _ = pages.flatten(_stored_pages(spark, d))
    rows = social.with_reply_target(posts, users)
    return rows.select("tweet_id", "in_reply_to_user_id", "username_target")


@query
def enrich_place(spark: SparkSession, d: str) -> DataFrame:
    posts, _, places = pages.flatten(_stored_pages(spark, d))
    rows = social.with_place(posts, places)
    return rows.select("tweet_id", "geo_id", "country_code", "country", "full_name")


@query
def enrich_posts(spark: SparkSession, d: str) -> DataFrame:
    """All lookups of a post at once, with the constant columns of the post table."""
    rows = social.enrich(*pages.flatten(_stored_pages(spark, d)))
    return rows.select("tweet_id", "username_source", "username_target", "country_code", "country", "full_name", "media", "headline")


def _search(spark: SparkSession, d: str) -> DataFrame:
    return social.search(
        fx.articles(spark, d), "the", ["whst", "heention"], "en", "2024-01-03", "2024-01-26"
    )


@query
def keyword_search(spark: SparkSession, d: str) -> DataFrame:
    return _search(spark, d).select("doc_id", "ts", "media")


@query
def capped_scan(spark: SparkSession, d: str) -> DataFrame:
    return social.capped(_search(spark, d), 100, ["ts", "doc_id"]).select("doc_id", "ts")


@query
def dedup_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.articles(spark, d).select("date", "media", "title", "article").dropDuplicates()
    return rows.withColumn("article", F.sha2("article", 256))


@query
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.table(spark, d, "events").select("user_id", "event_id", "ts", "value")
    return skew.first_per_group(rows, ["user_id"], [F.col("ts"), F.col("event_id")])


# Text ---------------------------------------------------------------------------


@query
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return fx.raw_posts(spark, d).select("event_id", text.normalize(F.col("article")).alias("article"))


@query
def mask_tokens(spark: SparkSession, d: str) -> DataFrame:
    return fx.raw_posts(spark, d).select("event_id", text.mask_tokens(F.col("article")).alias("article"))


@query
def extract_mentions(spark: SparkSession, d: str) -> DataFrame:
    found = F.array_join(text.mentions(F.col("article")), " ")
    return fx.raw_posts(spark, d).select("event_id", found.alias("mentions"))


@query
def extract_hashtags(spark: SparkSession, d: str) -> DataFrame:
    found = F.array_join(text.hashtags(F.col("article")), " ")
    return fx.raw_posts(spark, d).select("event_id", found.alias("hashtags"))


@query
def cut_at_marker(spark: SparkSession, d: str) -> DataFrame:
    credited = F.concat("article", F.lit("\nImage Credits: "), "source")
    return fx.articles(spark, d).select("doc_id", text.cut_at(credited).alias("article"))


@query
def trim_boilerplate(spark: SparkSession, d: str) -> DataFrame:
    return fx.articles(spark, d).select("doc_id", text.trim_lines(F.col("article")).alias("article"))


@query
def parse_three_line(spark: SparkSession, d: str) -> DataFrame:
    parts = text.three_lines(F.col("article")).alias("parts")
    rows = fx.articles(spark, d).select("doc_id", parts)
    return rows.select("doc_id", "parts.title", F.col("parts.date").alias("date_text"), "parts.article")


@query
def page_article(spark: SparkSession, d: str) -> DataFrame:
    html = F.col("html")
    return fx.table(spark, d, "pages").select(
        "page_id",
        text.page_headline(html).alias("headline"),
        text.page_paragraphs(html).alias("article"),
    )


@query
def page_markup(spark: SparkSession, d: str) -> DataFrame:
    """``page_article`` from the tokens of each page, for pages that patterns break on."""
    pages_ = fx.table(spark, d, "pages").select("page_id", markup.page_article("html").alias("page"))
    return pages_.select("page_id", "page.headline", "page.article")


@query
def relative_time(spark: SparkSession, d: str) -> DataFrame:
    resolved = reltime.resolve(F.col("scraped_at"), F.col("said"))
    return fx.relative_times(spark, d).select("event_id", resolved.alias("resolved"))


@query
def parse_year_month(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_orderkey")
    sep = F.when(key % 3 == 0, "-").when(key % 3 == 1, "/").otherwise(":")
    said = F.replace(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), sep)
    rows = fx.table(spark, d, "orders").select("o_orderkey", reltime.year_month(said).alias("ym"))
    return rows.select("o_orderkey", "ym.year", "ym.month")


@query
def parse_decimal_comma(spark: SparkSession, d: str) -> DataFrame:
    printed = F.replace(F.format_string("%.2f", "o_totalprice"), F.lit("."), F.lit(","))
    said = F.when(F.col("o_orderkey") % 97 == 0, "n/a").otherwise(printed)
    rows = fx.table(spark, d, "orders")
    return rows.select("o_orderkey", reltime.decimal_comma(said).alias("price"))


@query
def build_vocab(spark: SparkSession, d: str) -> DataFrame:
    return sentiment.build_vocab(fx.words(fx.articles(spark, d)), 2000)


@query
def encode_fixed_length(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.words(fx.articles(spark, d))
    encoded = sentiment.encode(rows, "doc_id", sentiment.build_vocab(rows, 2000))
    used = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x)
    return encoded.select(
        "doc_id", F.array_join("input_ids", " ").alias("input_ids"), used.alias("n_tokens")
    )


@query
def encode_subwords(spark: SparkSession, d: str) -> DataFrame:
    """``encode_fixed_length`` with words outside the vocabulary cut to known pieces."""
    rows = fx.words(fx.articles(spark, d))
    encoded = pieces.encode_pieces(rows, "doc_id", pieces.build_pieces(rows, 2000))
    used = F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x)
    return encoded.select("doc_id", F.array_join("input_ids", " ").alias("input_ids"), used.alias("n_tokens"))


# Folds and evaluation -----------------------------------------------------------


@query
def fold_table(spark: SparkSession, d: str) -> DataFrame:
    first, last = folds.date_bounds(fx.prices(spark, d))
    table = folds.table(spark, first + dt.timedelta(365), last, train=365, test=30, gap=2)
    return table.withColumn("fold_id", F.col("fold_id").cast("long"))


@query
def rolling_folds(spark: SparkSession, d: str) -> DataFrame:
    prices = fx.prices(spark, d).select(*KEY, "date")
    first, last = folds.date_bounds(prices)
    return folds.assign(prices, first + dt.timedelta(365), last, train=365, test=30, gap=2)


@query
def monthly_folds(spark: SparkSession, d: str) -> DataFrame:
    prices = fx.prices(spark, d).select(*KEY, "date")
    _, last = folds.date_bounds(prices)
    return folds.assign(prices, dt.date(1997, 1, 1), last, train=12, test=3, gap=1, freq="months")


@query
def holdout_split(spark: SparkSession, d: str) -> DataFrame:
    return folds.holdout(fx.prices(spark, d), KEY, 14)


@query
def split_dates(spark: SparkSession, d: str) -> DataFrame:
    return folds.split_dates(fx.prices(spark, d), KEY, train=200, n=14)


@query
def threshold_class(spark: SparkSession, d: str) -> DataFrame:
    return fx.probabilities(spark, d).select(
        "doc_id", scoring.up_or_down(F.col("p")).alias("prediction")
    )


@query
def macro_f1(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.probabilities(spark, d).withColumn("predicted", F.col("p") > 0.5)
    return _rounded(evaluate.macro_f1(rows, ["lang"]), "macro_f1")


@query
def windowed_accuracy(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.probabilities(spark, d)
    return _rounded(evaluate.windowed_accuracy(rows, ["lang"], "doc_id"), "mean_acc", "std_acc")


# Ledger -------------------------------------------------------------------------


@query
def score_predictions(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(ledger.score_next(fx.predictions(spark, d), KEY), "price_diff", digits=4)


@query
def asof_last_prediction(spark: SparkSession, d: str) -> DataFrame:
    return ledger.last_prediction(fx.prices(spark, d), fx.predictions(spark, d), KEY)


@query
def asof_events(spark: SparkSession, d: str) -> DataFrame:
    """Every click with the last view of its user within two days before it, at event size."""
    events = fx.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    clicks = events.where(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    views = events.where(F.col("event_type") == "view").select("user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    return asof.asof_join(
        clicks, views, ["user_id"], "ts", ["view_id", "view_value"], "view_id",
        tolerance=F.make_dt_interval(F.lit(2)), matched="view_ts",
    )


@query
def ledger_append(spark: SparkSession, d: str) -> DataFrame:
    rows = ledger.outcomes(fx.prices(spark, d), fx.predictions(spark, d), KEY)
    stored = rows.where(F.col("datetime") < "2000-01-01").withColumn("outcome", F.lit("Stored"))
    new = rows.where(F.col("datetime") >= "1999-06-01")
    return _rounded(ledger.append(new, stored, KEY), "price_diff", digits=4)


@query
def forecast_day(spark: SparkSession, d: str) -> DataFrame:
    settings = daily_job.Settings(
        train_days=14,
        holdout_days=7,
        step=7,
        selection_gap=7,
        selector=SMALL,
        candidates=SEARCH,
    )
    record = daily_job.forecast(_full_table(spark, d), KEY, settings)
    return record.withColumn("selected_features", F.array_join("selected_features", ","))


def _forecasts(spark: SparkSession, d: str) -> DataFrame:
    """Forecast rows, written once: the reports below read them several times."""
    path = scratch_dir(spark, "forecasts")
    flagship.forecasts(_full_table(spark, d), KEY).write.parquet(path)
    return spark.read.parquet(path)


@query
def current_prediction(spark: SparkSession, d: str) -> DataFrame:
    rows = _forecasts(spark, d)
    known = (F.col("date") <= dt.date(2024, 1, 25)) | (F.col("series_id") == "s2")
    stored = ledger.current(rows.where(known), None, KEY)
    return ledger.current(rows, stored.withColumn("reference_price", F.lit(-1.0)), KEY)


@query
def prediction_history(spark: SparkSession, d: str) -> DataFrame:
    # A probability of prices with two digits can lie halfway between two sixth digits; it is moved off there.
    rows = ledger.history(flagship.forecasts(_full_table(spark, d), KEY), KEY)
    moved = rows.withColumns({c: F.col(c) + F.lit(1e-9) for c in ("p", "news_sentiment")})
    return _rounded(moved, "p", "news_sentiment")


@query
def sentiment_history(spark: SparkSession, d: str) -> DataFrame:
    twitter = fx.posts(spark, d).where(F.col("media") == "twitter")
    totals = sentiment.polarity_totals(twitter, KEY)
    return ledger.sentiment_history(totals, KEY, dt.date(2024, 1, 30))


@query
def trend_history(spark: SparkSession, d: str) -> DataFrame:
    halved = fx.trends(spark, d).withColumn("trends", F.col("trends") / 2.0)
    return ledger.trend_history(halved, KEY, dt.date(2024, 1, 30))


@query
def prediction_record(spark: SparkSession, d: str) -> DataFrame:
    rows = _forecasts(spark, d)
    day = F.unix_date("date").cast("long").alias("day")
    judged = folds.holdout(rows, KEY, 14).where(F.col("is_price_up").isNotNull())
    judged = judged.select(*KEY, "date", day, "role", "p", F.col("is_price_up").alias("actual"))

    scored = _rounded(evaluate.windowed_accuracy(judged, [*KEY, "role"], "day"), "mean_acc", "std_acc")

    def of(role: str, prefix: str) -> list[Column]:
        own = F.col("role") == role
        return [
            F.max(F.when(own, F.col("mean_acc"))).alias(f"{prefix}eval_acc"),
            F.max(F.when(own, F.col("std_acc"))).alias(f"{prefix}eval_acc_7days_std"),
        ]

    metrics = scored.groupBy(*KEY).agg(*of("train", ""), *of("test", "holdout_"))
    published = ledger.record(series.latest(rows, KEY), metrics, KEY, ["trends", "twitter_score"])
    return published.withColumn("selected_features", F.array_join("selected_features", ","))


# Checks -------------------------------------------------------------------------


@query
def check_dates(spark: SparkSession, d: str) -> DataFrame:
    return checks.dates(fx.relative_times(spark, d), ["event_type"], "said")


@query
def check_duplicate_text(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_text(fx.articles(spark, d), ["lang"])


@query
def check_daily_cardinality(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.order_posts(spark, d).select(*KEY, "date")
    days = calendar.spine(rows, KEY, LONG_TODAY, LONG_PERIOD)
    return checks.daily_cardinality(rows, days, KEY)


@query
def usable_days(spark: SparkSession, d: str) -> DataFrame:
    return checks.usable_days(fx.order_posts(spark, d), KEY, "2000-12-31")


# Sources and sinks --------------------------------------------------------------


@query
def scan_day_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    rows = fx.articles(spark, d).select("title", "article", "date", "media")
    writers.write_daily(rows, path, fmt="csv")
    stored = daily.read_day(spark, path, daily.ARTICLE_SCHEMA, dt.date(2024, 1, 9))
    return stored.select("date", "media", "title", F.sha2("article", 256).alias("article"))


@query
def scan_day_fallback(spark: SparkSession, d: str) -> DataFrame:
    wanted, fallback = dt.date(1998, 3, 2), dt.date(1998, 2, 20)
    rows = fx.table(spark, d, "orders").select(
        F.concat("o_orderpriority", F.lit("-"), F.col("o_custkey") % 50).alias("series_id"),
        F.to_date("o_orderdate").alias("date"),
        "o_orderkey",
    )
    return daily.resolve_day(rows, KEY, wanted, fallback)


@query
def file_date(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "files")
    writers.write_daily(fx.close(spark, d), path, fmt="json")
    stored = spark.read.schema("series_id string, close_price double").json(path)
    dated = stored.select(daily.file_date().alias("file_date"), "close_price")
    return dated.groupBy("file_date").agg(F.count("*").alias("n"))


def _by_media_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date", "media").agg(
        F.count("*").alias("n"), F.sum(F.length("article")).alias("n_chars")
    )


@query
def write_by_date(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "by-date")
    rows = fx.articles(spark, d).select("title", "article", "date", "media")
    writers.write_daily(rows, path)
    return _by_media_day(daily.read(spark, path, daily.ARTICLE_SCHEMA, fmt="parquet"))


def _redelivered(spark: SparkSession, d: str, mode: str) -> DataFrame:
    """All days, then the English articles of the last days once more."""
    path = scratch_dir(spark, mode)
    rows = fx.articles(spark, d).select("title", "article", "date", "media", "lang")
    late = rows.where((F.col("date") >= dt.date(2024, 1, 20)) & (F.col("lang") == "en"))
    writers.write_daily(rows.drop("lang"), path)
    writers.write_daily(late.drop("lang"), path, mode=mode)
    return _by_media_day(daily.read(spark, path, daily.ARTICLE_SCHEMA, fmt="parquet"))


@query
def write_day_overwrite(spark: SparkSession, d: str) -> DataFrame:
    return _redelivered(spark, d, "overwrite")


@query
def write_day_append(spark: SparkSession, d: str) -> DataFrame:
    return _redelivered(spark, d, "append")


@query
def insert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    trends = fx.trends(spark, d)
    stored = trends.where(F.col("date") <= dt.date(2024, 1, 20))
    new = trends.where(F.col("date") >= dt.date(2024, 1, 15)).withColumn(
        "trends", F.col("trends") + 1000
    )
    return writers.insert_if_absent(new, stored, [*KEY, "date"])


@query
def upsert_by_date(spark: SparkSession, d: str) -> DataFrame:
    close = fx.close(spark, d)
    new = close.where(F.col("date") >= dt.date(2024, 1, 15)).withColumn(
        "close_price", F.col("close_price") * 2
    )
    return writers.upsert(new, close, [*KEY, "date"])


@query
def insert_stored_days(spark: SparkSession, d: str) -> DataFrame:
    """``insert_if_absent`` into stored days: only the days of the delivery are read and replaced."""
    path, trends = scratch_dir(spark, "inserted"), fx.trends(spark, d)
    merge.insert_days(trends.where(F.col("date") <= dt.date(2024, 1, 20)), path, [*KEY, "date"])
    new = trends.where(F.col("date") >= dt.date(2024, 1, 15)).withColumn("trends", F.col("trends") + 1000)
    merge.insert_days(new, path, [*KEY, "date"])
    return spark.read.schema(trends.schema).parquet(path)


@query
def upsert_stored_days(spark: SparkSession, d: str) -> DataFrame:
    """``upsert_by_date`` into stored days."""
    path, close = scratch_dir(spark, "upserted"), fx.close(spark, d)
    merge.upsert_days(close, path, [*KEY, "date"])
    new = close.where(F.col("date") >= dt.date(2024, 1, 15)).withColumn("close_price", F.col("close_price") * 2)
    merge.upsert_days(new, path, [*KEY, "date"])
    return spark.read.schema(close.schema).parquet(path)


@query
def versioned_tables(spark: SparkSession, d: str) -> DataFrame:
    """A table that grows by a version's rows beside one that is replaced; old versions go."""
    root = scratch_dir(spark, "versions")
    trends, close = fx.trends(spark, d), fx.close(spark, d)
    for first, last in ((1, 10), (11, 20), (21, 31)):
        new = trends.where(F.day("date").between(first, last))
        versions.commit(spark, root, {"trends": versions.Change(new, append=True), "close": versions.Change(close.where(F.day("date") <= last))})
    versions.expire(spark, root, keep=1)
    tables = versions.tables(spark, root, versions.load(spark, root))
    return tables["trends"].join(tables["close"], [*KEY, "date"])


@query
def write_record_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    scored = influence.score(fx.influencers(spark, d), fx.posts(spark, d), KEY)
    writers.write_daily(scored, path, fmt="json", dedup=False)
    schema = "series_id string, influence_score double, date date"
    return _rounded(daily.read(spark, path, schema), "influence_score", digits=4)


@query
def publish_tables(spark: SparkSession, d: str) -> DataFrame:
    root = scratch_dir(spark, "published")
    trends, close = fx.trends(spark, d), fx.close(spark, d)
    early = F.col("date") <= dt.date(2024, 1, 20)
    writers.publish(spark, {"trends": trends.where(early), "close": close.where(early)}, root, 1)
    writers.publish(spark, {"trends": trends, "close": close}, root, 2)
    tables = writers.published(spark, root)
    return tables["trends"].join(tables["close"], [*KEY, "date"])


# Streams ------------------------------------------------------------------------


def _drops(spark: SparkSession, d: str) -> DataFrame:
    """Daily files with one day delivered twice, as a stream."""
    path = scratch_dir(spark, "drops")
    events = fx.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    dated = events.withColumn("date", F.to_date("ts"))
    again = dated.where(F.col("date") == dt.date(2024, 1, 15))
    writers.write_daily(dated, f"{path}/first", dedup=False)
    writers.write_daily(again, f"{path}/again", dedup=False)
    reader = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true")
    return reader.parquet(path)


@query
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    path, checkpoint = scratch_dir(spark, "ingested"), scratch_dir(spark, "ingest-state")
    arrivals.ingest(_drops(spark, d), "event_id", path, checkpoint)
    return spark.read.parquet(path).drop("batch")


@query
def stream_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    path, checkpoint = scratch_dir(spark, "counted"), scratch_dir(spark, "count-state")
    arrivals.daily_counts(_drops(spark, d), ["event_type"], "event_id", path, checkpoint)
    return spark.read.parquet(f"{path}/counts").select("date", "event_type", "n")


@query
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    path, checkpoint = scratch_dir(spark, "unique"), scratch_dir(spark, "unique-state")
    arrivals.dedup(_drops(spark, d), "event_id", path, checkpoint)
    return spark.read.parquet(path).drop("batch")


# Models -------------------------------------------------------------------------

SMALL = model.Params(trees=3, depth=2)
SEARCH = model.draw_params(4, trees=(4, 8), min_gain=(0, 2))
#: The whole search: trials, trees and least gains as in the reference.
TRIALS = model.draw_params(20)
#: Two rounds of one split each: small enough for SQL to grow them too.
STUMPS = [
    model.Params(trees=2, depth=1, rate=rate, row_share=1.0, column_share=1.0, min_gain=gain, l1=l1, l2=l2)
    for rate, gain, l1, l2 in STUMP_SETTINGS
]


def _panel(spark: SparkSession, d: str) -> tuple[DataFrame, list[str]]:
    """The feature table, written once: model fits pass over it many times."""
    path = scratch_dir(spark, "panel")
    features.drop_non_features(_full_table(spark, d)).write.parquet(path)
    panel = spark.read.parquet(path)
    return panel, features.feature_columns(panel, KEY)


@query
def train_predict(spark: SparkSession, d: str) -> DataFrame:
    """Every series' last day, predicted from all others."""
    panel, columns = _panel(spark, d)
    scored = model.fit_predict(panel, KEY, columns, SMALL)
    return scored.select(*KEY, "date", "p", scoring.up_or_down(F.col("p")).alias("prediction"))


@query
def top_features(spark: SparkSession, d: str) -> DataFrame:
    """The ten features with the largest share of the gain."""
    panel, columns = _panel(spark, d)
    picked = model.top_features(panel, KEY, columns, n=10, skip_last=7, params=SMALL)
    order = Window.orderBy(F.desc("importance"), "feature")
    return picked.select(F.row_number().over(order).alias("position"), "feature", "importance")


def _folded(panel: DataFrame) -> model.FoldTable:
    first, last = folds.date_bounds(panel)
    return model.fold_table(panel, first + dt.timedelta(14), last, train=14, test=7)


@query
def cv_predictions(spark: SparkSession, d: str) -> DataFrame:
    panel, columns = _panel(spark, d)
    scored = model.cv_predict(_folded(panel), columns, SMALL)
    return scored.select(*KEY, "date", "fold_id", "is_price_up", "p")


@query
def random_search(spark: SparkSession, d: str) -> DataFrame:
    """Every trial with its parameters and the macro-F1 of its stored predictions."""
    panel, columns = _panel(spark, d)
    return model.random_search(_folded(panel), columns, SEARCH).trials


@query
def boosted_stumps(spark: SparkSession, d: str) -> DataFrame:
    """Out-of-fold probabilities of all trials and folds, grown together, with fixed bounds between bins."""
    panel, _ = _panel(spark, d)
    cuts = [np.array(STUMP_CUTS, "float64")] * len(STUMP_FEATURES)
    scored = model.cross_validate(_folded(panel), STUMP_FEATURES, STUMPS, cuts)
    return _rounded(scored.select("trial", "fold_id", *KEY, "date", "is_price_up", "p"), "p")


@query
def stump_search(spark: SparkSession, d: str) -> DataFrame:
    """The macro-F1 of each trial of ``boosted_stumps``."""
    panel, _ = _panel(spark, d)
    cuts = [np.array(STUMP_CUTS, "float64")] * len(STUMP_FEATURES)
    scored = model.cross_validate(_folded(panel), STUMP_FEATURES, STUMPS, cuts)
    return _rounded(model.macro_f1_of(scored, ["trial"]), "macro_f1")


@query
def evaluate_model(spark: SparkSession, d: str) -> DataFrame:
    """The accuracy of every series over runs of seven predictions, in tuning and hold-out folds."""
    panel, columns = _panel(spark, d)
    return model.evaluate_model(panel, KEY, columns, train=14, holdout=7, candidates=TRIALS).metrics


def _labelled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = fx.words(fx.articles(spark, d)).select("doc_id", "date", "media", "content")
    return rows, rows.join(fx.table(spark, d, "labels"), "doc_id")


def _relevance(spark: SparkSession, d: str) -> tuple[DataFrame, PipelineModel]:
    rows, labelled = _labelled(spark, d)
    return rows, model.fit_text(labelled.withColumn("label", F.col("quality").cast("double")))


@query
def text_relevance(spark: SparkSession, d: str) -> DataFrame:
    """The class of every text and its probability."""
    rows, fitted = _relevance(spark, d)
    scored = model.classify_text(fitted, rows)
    return scored.select("doc_id", "prediction", F.col("probabilities")[1].alias("p_relevant"))


@query
def relevance_filter(spark: SparkSession, d: str) -> DataFrame:
    """Texts of class 1."""
    rows, fitted = _relevance(spark, d)
    return model.relevant(fitted, rows).select("doc_id", "date", "media")


def _split(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``words`` of each text in place of it: they are split once, not for each aspect."""
    return rows.withColumn("words", text.words(rows, "content")).drop("content")


def _aspect_labels(spark: SparkSession, labelled: DataFrame) -> DataFrame:
    """The words of the labelled texts per aspect, with the class that the lexicon gives them."""
    marked = sentiment.lexicon_polarity(labelled, ["doc_id"], fx.lexicon(spark))
    index = F.array_position(F.array(*[F.lit(p) for p in scoring.POLARITIES]), F.col("polarity")) - 1
    return _split(labelled).join(marked.select("doc_id", "aspect", index.cast("double").alias("label")), "doc_id")


@query
def text_polarity(spark: SparkSession, d: str) -> DataFrame:
    """A polarity for every text and aspect, learned from labels that differ by aspect."""
    rows, labelled = _labelled(spark, d)
    fitted = model.fit_text(_aspect_labels(spark, labelled), text_col="words", pair_col="aspect")
    scored = model.classify_text(fitted, sentiment.expand_aspects(_split(rows)), text_col="words", pair_col="aspect")
    label = scoring.argmax_label(F.col("probabilities"), scoring.POLARITIES)
    return scored.select("doc_id", "aspect", label.alias("polarity"))


NETWORK = network.Shape(classes=2, steps=12, rate=0.1)


@query
def network_relevance(spark: SparkSession, d: str) -> DataFrame:
    """The relevance of every text by the network, trained on the labelled ones."""
    rows, labelled = _labelled(spark, d)
    fitted = network.fit(labelled.withColumn("label", F.col("quality")), NETWORK)
    scored = network.classify(fitted, rows, keep=["doc_id"])
    return scored.select("doc_id", "prediction", F.col("probabilities")[1].alias("p_relevant"))


@query
def network_polarity(spark: SparkSession, d: str) -> DataFrame:
    """A polarity for every text and aspect by the network, learned from the lexicon's labels."""
    rows, labelled = _labelled(spark, d)
    shape = replace(NETWORK, classes=len(scoring.POLARITIES))
    fitted = network.fit(_aspect_labels(spark, labelled), shape, text_col="words", pair_col="aspect")
    every = sentiment.expand_aspects(_split(rows))
    scored = network.classify(fitted, every, text_col="words", pair_col="aspect", keep=["doc_id", "aspect"])
    label = scoring.argmax_label(F.col("probabilities"), scoring.POLARITIES)
    return scored.select("doc_id", "aspect", label.alias("polarity"))


@query
def batch_infer(spark: SparkSession, d: str) -> DataFrame:
    def load() -> Callable[[pd.DataFrame], pd.DataFrame]:
        """A stand-in network: the logistic of the text's length.

        Defined in place, so it travels to the workers whole.
        """

        def score(batch: pd.DataFrame) -> pd.DataFrame:
            size = batch["content"].str.len().to_numpy(dtype=float)
            chance = 1.0 / (1.0 + np.exp(-(size - 1000.0) / 1000.0))
            return pd.DataFrame({"doc_id": batch["doc_id"], "p": np.round(chance, 6)})

        return score

    rows = fx.words(fx.articles(spark, d)).select("doc_id", "content")
    return sentiment.batch_infer(rows, load, "doc_id long, p double", batch_size=32)
