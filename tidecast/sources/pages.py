"""Nested API pages: one JSON document per response, flattened into tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.operators.skew import first_per_group

PAGE_SCHEMA = """
    data array<struct<
        id: string, text: string, author_id: string, in_reply_to_user_id: string,
        geo: struct<place_id: string>, created_at: string, lang: string,
        conversation_id: string, reply_settings: string, source: string,
        referenced_tweets: array<struct<type: string>>,
        public_metrics: struct<retweet_count: bigint, reply_count: bigint,
                               like_count: bigint, quote_count: bigint>>>,
    includes struct<
        users: array<struct<id: string, username: string>>,
        places: array<struct<id: string, country_code: string, country: string,
                             full_name: string>>>,
    meta struct<result_count: bigint, next_token: string>
"""


def parse(raw: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to typed pages. Absent fields are NULL, so the schema never drifts."""
    return raw.select(F.from_json(column, PAGE_SCHEMA).alias("page")).select("page.*")


def dump(raw: DataFrame, path: str, column: str = "value") -> None:
    """Keep the pages as they came, one JSON document per line."""
    raw.select(column).write.mode("append").text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Dumped pages, typed. Only the top-level fields a query uses are parsed."""
    return spark.read.schema(PAGE_SCHEMA).json(path)


def posts(pages: DataFrame) -> DataFrame:
    """One row per post, with its type and place; bookkeeping fields dropped."""
    rows = pages.select(F.inline("data"))
    return rows.select(
        F.col("id").alias("tweet_id"),
        "author_id",
        "in_reply_to_user_id",
        F.col("created_at").alias("date"),
        F.col("text").alias("article"),
        F.try_element_at("referenced_tweets", F.lit(1))["type"].alias("tweet_type"),
        F.col("geo.place_id").alias("geo_id"),
        "public_metrics",
    )


def users(pages: DataFrame) -> DataFrame:
    """Users of all pages, the first name per id."""
    rows = pages.select(F.inline("includes.users")).where(F.col("id").isNotNull())
    return first_per_group(rows, ["id"], [F.col("username")])


def places(pages: DataFrame) -> DataFrame:
    """Places of all pages, one row per id; pages without places add none."""
    rows = pages.select(F.inline("includes.places")).where(F.col("id").isNotNull())
    return first_per_group(
        rows, ["id"], [F.col("full_name"), F.col("country"), F.col("country_code")]
    )


def flatten(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Posts, users and places of typed pages."""
    return posts(pages), users(pages), places(pages)
