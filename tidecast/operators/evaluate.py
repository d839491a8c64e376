"""Metrics over scored predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.skew import number_rows


def macro_f1(
    df: DataFrame, keys: list[str] | None = None, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Unweighted mean of the per-class F1, over classes seen as actual or predicted."""
    keys = keys or []
    cells = df.groupBy(*keys, actual, predicted).agg(F.count("*").alias("n"))
    hit = F.col(actual) == F.col(predicted)
    as_actual = F.struct(
        F.col(actual).alias("class"),
        F.when(hit, F.col("n")).otherwise(0).alias("hits"),
        F.col("n").alias("seen"),
    )
    as_predicted = F.struct(
        F.col(predicted).alias("class"), F.lit(0).cast("long").alias("hits"), F.col("n").alias("seen")
    )
    per_class = (
        cells.select(*keys, F.inline(F.array(as_actual, as_predicted)))
        .groupBy(*keys, "class")
        .agg((2.0 * F.sum("hits") / F.sum("seen")).alias("f1"))
    )
    return per_class.groupBy(*keys).agg(F.avg("f1").alias("macro_f1"))


def windowed_accuracy(
    df: DataFrame,
    keys: list[str],
    row_id: str,
    size: int = 7,
    threshold: float = 0.5,
    probability: str = "p",
    actual: str = "actual",
) -> DataFrame:
    """Accuracy per run of ``size`` predictions, then mean and population deviation.

    Runs follow (date, row_id) within a series. The last run may be short and counts
    the same. ``actual`` is a boolean column.
    """
    numbered = number_rows(df, keys, "date", row_id)
    right = ((F.col(probability) > threshold) == F.col(actual)).cast("int")
    runs = (
        numbered.withColumn("_run", F.floor((F.col("rn") - 1) / size))
        .groupBy(*keys, "_run")
        .agg(F.avg(right).alias("_acc"))
    )
    return runs.groupBy(*keys).agg(
        F.avg("_acc").alias("mean_acc"), F.stddev_pop("_acc").alias("std_acc")
    )
