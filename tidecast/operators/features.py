"""The daily feature matrix: all sources side by side on a complete calendar."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL = "is_price_up"
NOT_FEATURES = r"^(total|sentiment)"


def union_sources(tables: list[DataFrame], zero: list[str] | None = None) -> DataFrame:
    """Union by column name; columns a table lacks are NULL, or 0 if listed in ``zero``."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return rows.fillna(0, subset=zero) if zero else rows


def build(
    tables: list[DataFrame],
    calendar: DataFrame,
    keys: list[str],
    keep_null: tuple[str, ...] = (LABEL,),
) -> DataFrame:
    """Full outer join of daily tables on the calendar, gaps filled with 0.

    Every table has at most one row per (series, day) and its own columns, so the outer
    join is a union followed by one ``max`` per column. The calendar is one more branch
    of the union: a marker says which days to keep. One shuffle, whatever the number of
    tables, where chained outer joins would need one or two for each.
    """
    marked = calendar.select(*keys, "date", F.lit(True).alias("_on_calendar"))
    rows = union_sources([*tables, marked])
    values = [c for c in rows.columns if c not in (*keys, "date", "_on_calendar")]
    merged = rows.groupBy(*keys, "date").agg(
        *[F.max(c).alias(c) for c in ["_on_calendar", *values]]
    )
    return (
        merged.where(F.col("_on_calendar"))
        .drop("_on_calendar")
        .fillna(0, subset=[c for c in values if c not in keep_null])
    )


def drop_non_features(df: DataFrame, pattern: str = NOT_FEATURES) -> DataFrame:
    """Drop bookkeeping columns by name."""
    return df.select(*[c for c in df.columns if not re.match(pattern, c)])


def feature_columns(df: DataFrame, keys: list[str]) -> list[str]:
    """What a model may look at: neither keys, date, label nor the raw close."""
    hidden = {*keys, "date", LABEL, "close_price"}
    return [c for c in df.columns if c not in hidden and not re.match(NOT_FEATURES, c)]
