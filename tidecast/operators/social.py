"""Posts: enrichment from users and places, search, author lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.operators.skew import spread_join


def with_author(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``username_source``, the name behind ``author_id``."""
    names = users.select("id", F.col("username").alias("username_source"))
    return spread_join(posts, names, "author_id", "id", row_id="tweet_id")


def with_reply_target(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Add ``username_target``, the name replied to. NULL for a post that is no reply."""
    names = users.select("id", F.col("username").alias("username_target"))
    return spread_join(posts, names, "in_reply_to_user_id", "id", row_id="tweet_id")


def with_place(posts: DataFrame, places: DataFrame) -> DataFrame:
    """Add country, country code and full place name; NULL where there is no place."""
    named = places.select("id", "country_code", "country", "full_name")
    return spread_join(posts, named, "geo_id", "id", row_id="tweet_id")


def enrich(posts: DataFrame, users: DataFrame, places: DataFrame) -> DataFrame:
    """All three lookups, plus the constant columns of the post table."""
    named = with_place(with_reply_target(with_author(posts, users), users), places)
    return named.withColumn("media", F.lit("twitter")).withColumn(
        "headline", F.lit(None).cast("string")
    )


def expand_metrics(posts: DataFrame, drop_source: bool = True) -> DataFrame:
    """Counters of ``public_metrics`` as columns of their own."""
    wide = posts.select("*", "public_metrics.*")
    return wide.drop("public_metrics") if drop_source else wide


def _has_word(text: Column, words: list[str]) -> Column:
    listed = "|".join(re.escape(w.lower()) for w in words)
    edge = r"[^\p{L}\p{N}_]"
    return F.lower(text).rlike(f"(^|{edge})({listed})({edge}|$)")


def search(
    posts: DataFrame,
    keyword: str,
    blacklist: list[str],
    lang: str,
    start: str,
    end: str,
    start_time: str = "00:00:00",
    end_time: str = "23:59:59",
) -> DataFrame:
    """Posts with the keyword, without any blacklisted word, in a language and period."""
    found = (
        (F.col("lang") == lang)
        & F.col("ts").between(
            F.lit(f"{start} {start_time}").cast("timestamp_ntz"),
            F.lit(f"{end} {end_time}").cast("timestamp_ntz"),
        )
        & F.contains(F.lower("article"), F.lit(keyword.lower()))
    )
    if blacklist:
        found = found & ~_has_word(F.col("article"), blacklist)
    return posts.where(found)


def capped(posts: DataFrame, max_count: int, order: list[str]) -> DataFrame:
    """Exactly the first ``max_count`` rows of a stated order."""
    return posts.orderBy(*order).limit(max_count)


def by_authors(posts: DataFrame, influencers: DataFrame) -> DataFrame:
    """Posts of listed authors: one semi-join instead of batches of names."""
    listed = influencers.select("handle")
    return spread_join(posts, listed, "author", "handle", row_id="tweet_id", how="left_semi")
