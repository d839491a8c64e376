"""Writers of daily tables, and the merge rules between a new and a stored one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "version bigint, name string, path string"
_CSV = {"header": True, "quoteAll": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\\N"}


def write_daily(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partitions: tuple[str, ...] = ("date",),
    dedup: bool = True,
    batch: str | None = None,
) -> None:
    """Write one partition per day, identical rows once.

    ``overwrite`` replaces the days in the batch and no others; ``append`` adds to them,
    without a second deduplication; ``batch`` keeps each delivery apart under its own
    name. ``rebalance`` cuts a day that holds most of the rows into several files and
    joins small ones, so neither one task nor a million files result.
    """
    rows = df.dropDuplicates() if dedup else df
    columns = list(partitions)
    if batch is not None:
        rows, columns = rows.withColumn("batch", F.lit(batch)), [*columns, "batch"]
    writer = rows.hint("rebalance", *columns).write.partitionBy(*columns).format(fmt)
    if fmt == "csv":
        writer = writer.options(**_CSV)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    elif mode != "append":
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    writer.mode(mode).save(path)


def skip_stored_days(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of days the stored table does not have: the 'cancel' answer for the others."""
    return df.join(existing.select("date").distinct(), "date", "left_anti")


def insert_if_absent(new: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """The stored rows, and the new rows whose key is not stored."""
    missing = new.join(existing.select(*on), on, "left_anti")
    return existing.unionByName(missing)


def upsert(new: DataFrame, existing: DataFrame, on: list[str]) -> DataFrame:
    """The new rows, and the stored rows whose key is not among them.

    One row per key on each side. One aggregation over the union: the newer row wins. For
    a large dated table, pass the stored days the new rows touch and write the result with
    ``write_daily``, which replaces those days only.
    """
    values = [c for c in existing.columns if c not in on]
    both = existing.withColumn("_newer", F.lit(0)).unionByName(new.withColumn("_newer", F.lit(1)))
    kept = both.groupBy(*on).agg(F.max_by(F.struct(*values), "_newer").alias("_row"))
    return kept.select(*on, "_row.*").select(*existing.columns)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, version: int) -> None:
    """Publish several tables at once: readers see all of them or none.

    Every table goes to a directory of this version. Only when all are written does one
    append to the manifest name them; if any write fails, it raises and the manifest
    still names the last complete version.
    """
    rows = []
    for name, df in tables.items():
        path = f"{root}/{name}/version={version}"
        df.write.mode("overwrite").parquet(path)
        rows.append((version, name, path))
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
    manifest.write.mode("append").json(f"{root}/_manifest")


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest complete version."""
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_manifest")
    newest = manifest.select(F.max("version")).scalar()
    named = manifest.where(F.col("version") == newest).select("name", "path").collect()
    return {row["name"]: spark.read.parquet(row["path"]) for row in named}
