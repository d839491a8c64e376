"""Influencers: who they are, what they post, how much that weighs per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.skew import spread_join, top_n_per_group


def top(
    influencers: DataFrame, k: int, per: list[str] | None = None, row_id: str = "handle"
) -> DataFrame:
    """The ``k`` highest ranked influencers, overall or per group, ties by handle."""
    order = [F.desc("rank"), F.col(row_id)]
    if not per:
        return influencers.orderBy(*order).limit(k)
    return top_n_per_group(influencers, per, order, k, row_id)


def posts_with_rank(influencers: DataFrame, posts: DataFrame) -> DataFrame:
    """Inner join of posts with the list, row by row; adds the list's columns.

    A handle listed twice counts twice. NULL handles match nothing. A hot author's posts
    are spread over several tasks.
    """
    return spread_join(posts, influencers, "author", "handle", row_id="tweet_id", how="inner")


def score(influencers: DataFrame, posts: DataFrame, keys: list[str]) -> DataFrame:
    """Sum of author ranks over the day's posts; 0 on a day without a match.

    Posts are counted per (series, day, author) and the list is summed per handle before
    they meet, so the join sees one row per author and day and not one per post.
    """
    ranks = influencers.groupBy("handle").agg(F.sum("rank").alias("rank"))
    per_author = posts.groupBy(*keys, "date", "author").agg(F.count("*").alias("_posts"))
    joined = per_author.join(ranks, per_author["author"] == ranks["handle"], "left")
    weight = F.col("rank") * F.col("_posts")
    return joined.groupBy(*keys, "date").agg(
        F.coalesce(F.sum(weight), F.lit(0.0)).alias("influence_score")
    )
