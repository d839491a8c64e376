"""Data-quality checks. Each returns the findings as rows; ``require_*`` raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class InvalidData(ValueError):
    """A batch that must not be processed."""


def dates(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows, missing dates and unparseable dates per group."""
    text = F.col(column)
    bad = text.isNotNull() & text.try_cast("timestamp_ntz").isNull()
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(text.isNull()).alias("n_missing"),
        F.count_if(bad).alias("n_invalid"),
    )


def require_dates(df: DataFrame, column: str) -> DataFrame:
    """Pass the batch through if every date parses, otherwise raise."""
    found = dates(df, [], column).first()
    if found["n_missing"] or found["n_invalid"]:
        raise InvalidData(
            f"{found['n_missing']} missing and {found['n_invalid']} invalid of {found['n']} dates"
        )
    return df


def duplicate_text(df: DataFrame, keys: list[str], column: str = "article") -> DataFrame:
    """Texts that occur more than once, by their SHA-256, with the number of copies.

    The digest stands in for the text in the shuffle, and copies are counted before it.
    """
    digest = F.sha2(F.col(column), 256)
    return (
        df.groupBy(*keys, digest.alias("text_sha256"))
        .agg(F.count("*").alias("copies"))
        .where(F.col("text_sha256").isNotNull() & (F.col("copies") > 1))
    )


def daily_cardinality(df: DataFrame, calendar: DataFrame, keys: list[str]) -> DataFrame:
    """Calendar days that do not have exactly one record: ``n`` is 0 or more than 1."""
    counted = df.groupBy(*keys, "date").agg(F.count("*").alias("n"))
    return (
        calendar.join(counted, [*keys, "date"], "left")
        .withColumn("n", F.coalesce(F.col("n"), F.lit(0)))
        .where(F.col("n") != 1)
    )


def require_daily_cardinality(df: DataFrame, calendar: DataFrame, keys: list[str]) -> DataFrame:
    """Pass the table through if no day has two records; a missing day is allowed."""
    double = daily_cardinality(df, calendar, keys).where(F.col("n") > 1)
    first = double.orderBy(*keys, "date").first()
    if first is not None:
        raise InvalidData(f"more than one record on {first['date']}")
    return df


def usable_days(df: DataFrame, keys: list[str], today: Column | str, offset: int = 2) -> DataFrame:
    """Days with data up to ``today``, less the days lost to lag and forecast."""
    limit = F.lit(today).cast("date") if isinstance(today, str) else today
    return (
        df.where(F.col("date") <= limit)
        .select(*keys, "date")
        .distinct()
        .groupBy(*keys)
        .agg((F.count("*") - offset).alias("usable_days"))
    )
