"""As-of join of tables of any size per key: each row with the last row of its key before it.

Both tables are stacked and range-partitioned by (key, time), so one key may span any number of
tasks. Within a piece the last known row is carried forward; what a piece hands on to the next
ones is one row per (key, piece), and those few rows are carried across the borders. No pair is
formed, no key is gathered in one task, and rows of one instant are spread too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import scratch_dir


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    time: str,
    values: list[str],
    tie: str | None = None,
    same_instant: bool = False,
    tolerance: Column | None = None,
    matched: str = "matched_time",
    pieces: int | None = None,
) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` before it, and that row's time as ``matched``.

    Both tables have the ``keys`` and ``time``. A right row of the same instant counts only with
    ``same_instant``; of right rows of one instant the largest ``tie`` counts. A match older
    than ``tolerance`` (an interval, or a number for numeric times) is no match. Rows without a match,
    a key or a time have nulls. ``pieces`` sets the number of ranges (None: the session's
    shuffle partitions). Left rows may repeat; columns of the left that are named like one of ``values``
    or ``matched`` raise.
    """
    clash = {*values, matched} & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    spark = left.sparkSession
    known = right.where(F.col(time).isNotNull()).dropna(subset=keys) if keys else right.where(F.col(time).isNotNull())
    made = F.struct(F.col(time).alias(matched), *values)
    order = F.col(tie).cast("long") if tie else F.lit(0).cast("long")
    asking = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(time).alias("_time"),
        F.lit(0 if not same_instant else 2).alias("_kind"),
        F.xxhash64(*left.columns).alias("_tie"),
        F.struct(*left.columns).alias("_row"),
    )
    telling = known.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(time).alias("_time"),
        F.lit(1).alias("_kind"),
        order.alias("_tie"),
        made.alias("_made"),
    )
    own = [f"_k{i}" for i in range(len(keys))]
    ranges = [*own, "_time", "_kind", "_tie"]
    stacked = asking.unionByName(telling, allowMissingColumns=True)
    ranged = stacked.repartitionByRange(pieces, *ranges) if pieces else stacked.repartitionByRange(*ranges)
    path = scratch_dir(spark, "as-of")
    ranged.withColumn("_piece", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)

    inside = Window.partitionBy(*own, "_piece").orderBy("_time", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*own).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max(F.when(F.col("_kind") == 1, F.struct("_time", "_tie", "_made")))
    borders = stored.groupBy(*own, "_piece").agg(latest.alias("_latest"))
    borders = borders.select(
        *[F.col(k).alias(f"{k}_b") for k in own],
        F.col("_piece").alias("_piece_b"),
        F.last("_latest._made", ignorenulls=True).over(before).alias("_carried"),
    )
    same = F.col("_piece") == F.col("_piece_b")
    for k in own:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_b"))
    found = stored.withColumn("_own", F.last("_made", ignorenulls=True).over(inside)).where(F.col("_kind") != 1)
    found = found.join(borders, same).withColumn("_match", F.coalesce("_own", "_carried"))
    valid = F.col("_time").isNotNull()
    if tolerance is not None:
        valid &= F.col("_time") - F.col(f"_match.{matched}") <= tolerance
    match = F.when(valid, F.col("_match"))
    rows = found.select("_row.*", match.alias("_found"))
    return rows.select(*left.columns, *[F.col(f"_found.{v}").alias(v) for v in values], F.col(f"_found.{matched}").alias(matched))
