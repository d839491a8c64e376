"""Daily arrivals as streams: exactly-once ingest, daily counts, deduplication.

Each query runs with ``availableNow``: it takes what has arrived since its last
checkpoint, in batches, and stops. Checkpoints and tables live in shared storage, so a
lost executor or a restarted job continues where it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructType

from tidecast.functions.reltime import as_utc


def arrivals(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """The stream of daily files under ``path``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _drain(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str
) -> None:
    query = (
        df.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """A name for the run that owns a checkpoint; a fresh checkpoint has a new one."""
    path = f"{checkpoint}/run"
    spark.createDataFrame([(uuid.uuid4().hex,)], "run string").write.mode("ignore").text(path)
    return spark.read.text(path).first()[0]


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def _write_batch(rows: DataFrame, batch: str, path: str) -> None:
    """Write a delivery under its own partition. Running it again replaces it."""
    (
        rows.withColumn("batch", F.lit(batch))
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch")
        .parquet(path)
    )


def _store_new(batch: DataFrame, name: str, row_id: str, path: str) -> None:
    """Store the rows of a delivery that no other delivery has stored."""
    spark = batch.sparkSession
    rows = batch.withColumn("date", F.to_date("ts")).dropDuplicates(["date", row_id])
    if _exists(spark, path):
        schema = StructType(batch.schema.fields).add("date", DateType()).add("batch", StringType())
        first, last = rows.agg(F.min("date"), F.max("date")).first()
        stored = spark.read.schema(schema).parquet(path)
        others = stored.where(F.col("date").between(first, last) & (F.col("batch") != name))
        rows = rows.join(others.select("date", row_id), ["date", row_id], "left_anti")
    _write_batch(rows, name, path)


def ingest(df: DataFrame, row_id: str, path: str, checkpoint: str) -> None:
    """Append rows not stored yet, exactly once, to a table partitioned by date.

    Rows that any other delivery stored, in this run or an earlier one, are anti-joined away
    on (date, row id); a range over the batch's own days keeps that comparison to the
    partitions it touches. A delivery is named by its run and its number, so one that is
    run again replaces itself alone.
    """
    run = _run_id(df.sparkSession, checkpoint)
    _drain(df, lambda batch, n: _store_new(batch, f"{run}-{n}", row_id, path), checkpoint, "append")


def daily_counts(df: DataFrame, keys: list[str], row_id: str, path: str, checkpoint: str) -> None:
    """Keep the table ``counts`` of ``n`` per (day, keys) up to date; late and repeated rows may arrive.

    Row ids are stored once, as ``ingest`` does; then the days that a batch touched are
    counted anew from what is stored and replaced. A row that is delivered twice counts once,
    however late it comes.
    """
    spark = df.sparkSession
    run = _run_id(spark, checkpoint)
    narrow = df.select(row_id, "ts", *[k for k in keys if k not in (row_id, "ts")])

    def write(batch: DataFrame, n: int) -> None:
        _store_new(batch, f"{run}-{n}", row_id, f"{path}/rows")
        schema = StructType(batch.schema.fields).add("date", DateType()).add("batch", StringType())
        days = batch.select(F.to_date("ts").alias("date")).distinct()
        first, last = days.agg(F.min("date"), F.max("date")).first()
        # The range prunes partitions; the semi-join takes the days between that no row is of.
        stored = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("date").between(first, last))
        counted = stored.join(days, "date", "left_semi").groupBy("date", *keys).agg(F.count("*").alias("n"))
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(f"{path}/counts")
        )

    _drain(narrow, write, checkpoint, "append")


def dedup(
    df: DataFrame, row_id: str, path: str, checkpoint: str, delay: str = "1 day"
) -> None:
    """Drop rows whose id was seen within the watermark delay; state is bounded by it."""
    unique = (
        df.withColumn("_event_time", as_utc(F.col("ts")))
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark([row_id])
        .drop("_event_time")
        .withColumn("date", F.to_date("ts"))
    )
    run = _run_id(df.sparkSession, checkpoint)
    _drain(unique, lambda rows, n: _write_batch(rows, f"{run}-{n}", path), checkpoint, "append")
