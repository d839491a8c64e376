"""Building blocks that keep one hot group from landing in one task.

A single key, day or source may hold a third of all rows. Plain ``row_number``
windows and plain equi-joins would send that third to one task; the helpers below
give the same answer with the group spread out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import scratch_dir


def top_n_per_group(
    df: DataFrame, keys: list[str], order: list[Column], n: int, row_id: str, salts: int = 32
) -> DataFrame:
    """The first ``n`` rows of every group, exactly, in two rounds.

    Round one keeps the first ``n`` of each (group, salt); every row of the true
    first ``n`` survives it. Round two then sees at most ``n * salts`` rows per
    group, whatever the group's size. Both rounds plan a ``WindowGroupLimit``, so
    rows are trimmed before each shuffle too.
    """
    first = Window.partitionBy(*keys, "_salt").orderBy(*order)
    second = Window.partitionBy(*keys).orderBy(*order)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(row_id), F.lit(salts)))
    trimmed = salted.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n)
    ranked = trimmed.withColumn("_rank", F.row_number().over(second)).where(F.col("_rank") <= n)
    return ranked.drop("_salt", "_rank")


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every group by ``order``.

    ``min_by`` combines on the map side, so each task ships one row per group and a
    hot group costs no more than a cold one.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(*keys, "_row.*").select(*df.columns)


def number_rows(
    df: DataFrame, keys: list[str], date: str, row_id: str, pieces: int = 64, out: str = "rn"
) -> DataFrame:
    """``row_number`` per key by (date, row_id) without a window over the whole key.

    Each (key, date) is cut into ``pieces`` at quantiles of its ids, so the pieces are even
    however the ids are spaced. The cuts are stored, so that both passes use the same ones;
    the numbers do not depend on where they lie. A running sum over the piece counts gives
    each piece its offset, and the window that orders rows stays inside one piece.
    ``row_id`` must be an integer, unique per (key, date). Groups are matched null-safe, so a
    NULL key is numbered like any other.
    """
    spark = df.sparkSession
    group = F.struct(*keys, date)
    path = scratch_dir(spark, "cuts")
    quantiles = F.percentile_approx(row_id, [k / pieces for k in range(1, pieces)], 1000)
    df.groupBy(group.alias("_group")).agg(quantiles.alias("_cuts")).write.parquet(path)
    cut = df.withColumn("_group", group).join(spark.read.parquet(path), "_group")
    below = F.size(F.filter("_cuts", lambda c: c < F.col(row_id)))
    cut = cut.withColumn("_piece", F.struct(*keys, date, below.alias("_cut"))).drop("_group", "_cuts")
    earlier = (
        Window.partitionBy(*[f"_piece.{k}" for k in keys])
        .orderBy(f"_piece.{date}", "_piece._cut")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy("_piece")
        .agg(F.count("*").alias("_n"))
        .select("_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_piece").orderBy(row_id)
    return (
        cut.join(offsets, "_piece")
        .withColumn(out, F.row_number().over(inside) + F.col("_before"))
        .drop("_piece", "_before")
    )


def spread_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    row_id: str,
    how: str = "left",
) -> DataFrame:
    """Join a fact table with a lookup; left, inner or semi.

    Facts with a NULL key match nothing, so they are spread over many join buckets instead of
    meeting in one. The lookup is not repeated: Spark broadcasts it when its own size is
    under the session's threshold and sort-merges otherwise, with the adaptive skew split
    for a hot key.
    """
    spread = F.pmod(F.xxhash64(row_id), F.lit(4096)) + 1
    bucket = F.when(F.col(fact_key).isNull(), spread).otherwise(0)
    left = facts.withColumn("_bucket", bucket.cast("int"))
    right = lookup.withColumnRenamed(lookup_key, "_lookup_key").withColumn("_lookup_bucket", F.lit(0))
    matched = (F.col(fact_key) == F.col("_lookup_key")) & (
        F.col("_bucket") == F.col("_lookup_bucket")
    )
    return left.join(right, matched, how).drop("_bucket", "_lookup_key", "_lookup_bucket")
