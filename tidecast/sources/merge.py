"""Merges into a stored table of days: only the days of the batch are read and replaced.

A merge first writes the merged days to a journal inside the table (a folder that readers skip),
then replaces those days from it. Whatever stops it, the next merge ends what a complete
journal holds and drops an incomplete one, so a run can always be repeated and a day is never
lost between its old and its new files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidecast.sources.writers import insert_if_absent, upsert

_JOURNAL = "_merge"
Rule = Callable[[DataFrame, DataFrame, list[str]], DataFrame]


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def _replace_days(spark: SparkSession, journal: str, path: str, schema: StructType) -> None:
    rows = spark.read.schema(schema).parquet(f"{journal}/rows")
    (
        rows.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def recover(spark: SparkSession, path: str, schema: StructType) -> int:
    """End merges that were stopped after their journal was complete, in their order; drop the others. How many were ended."""
    files, folder = _files(spark, f"{path}/{_JOURNAL}")
    if not files.exists(folder):
        return 0
    ended = 0
    for name in sorted(s.getPath().getName() for s in files.listStatus(folder)):
        journal = f"{path}/{_JOURNAL}/{name}"
        _, done = _files(spark, f"{journal}/rows/_SUCCESS")
        _, place = _files(spark, journal)
        if files.exists(done):
            _replace_days(spark, journal, path, schema)
            ended += 1
        files.delete(place, True)
    return ended


def stored_days(spark: SparkSession, path: str, schema: StructType, days: list) -> DataFrame:
    """The stored rows of some days: a filter on the partition column, so other days are not listed or read."""
    files, folder = _files(spark, path)
    if not files.exists(folder) or not days:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).where(F.col("date").isin(days))


def merge(batch: DataFrame, path: str, on: list[str], rule: Rule) -> list:
    """Merge ``batch`` into the table at ``path`` by ``rule`` (``insert_if_absent`` or ``upsert``); the days it replaced.

    ``on`` holds ``date``, and keys are unique per side. The batch's days come to the driver, as
    many as a calendar has; a row without a day raises. One writer at a time.
    """
    spark = batch.sparkSession
    if "date" not in on:
        raise ValueError("the key of a dated table holds its date")
    recover(spark, path, batch.schema)
    found = [r["date"] for r in batch.select("date").distinct().collect()]
    if None in found:
        raise ValueError("a row without a date has no place in a table of days")
    if not found:
        return []
    days = sorted(found)
    merged = rule(batch, stored_days(spark, path, batch.schema, days), on).select(batch.columns)
    # Names sort by time of writing, so recovery follows the order of merges.
    _, folder = _files(spark, f"{path}/{_JOURNAL}")
    number = len(_files(spark, path)[0].listStatus(folder)) if _files(spark, path)[0].exists(folder) else 0
    journal = f"{path}/{_JOURNAL}/{number:06d}-{uuid.uuid4().hex}"
    merged.write.parquet(f"{journal}/rows")
    _replace_days(spark, journal, path, batch.schema)
    files, place = _files(spark, journal)
    files.delete(place, True)
    return days


def insert_days(batch: DataFrame, path: str, on: list[str]) -> list:
    """Store the rows whose key is not stored yet; stored rows stay."""
    return merge(batch, path, on, insert_if_absent)


def upsert_days(batch: DataFrame, path: str, on: list[str]) -> list:
    """Store the rows of the batch; stored rows of the same keys give way."""
    return merge(batch, path, on, upsert)
