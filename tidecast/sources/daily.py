"""Readers of daily tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ARTICLE_SCHEMA = "title string, article string, date date, media string"
SENTIMENT_SCHEMA = (
    "total_docs bigint, sentiment map<string, map<string, bigint>>, date date, media string"
)
DATE_PATTERN = r"(\d{4}-\d{2}-\d{2})"


class NoData(LookupError):
    """A wanted day is not in the table."""


class SeveralDeliveries(LookupError):
    """A wanted day was delivered more than once."""


def read(
    spark: SparkSession,
    path: str,
    schema: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    fmt: str = "json",
    columns: list[str] | None = None,
) -> DataFrame:
    """A daily table between two dates, both included and both optional.

    The schema is always given: nothing is inferred, an absent column is NULL, and an
    empty window is an empty typed frame. The date range prunes partitions.
    """
    if fmt == "csv":
        df = _read_csv(spark, path, StructType.fromDDL(schema))
    else:
        df = spark.read.schema(schema).format(fmt).load(path)
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end))
    return df.select(*columns) if columns else df


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV columns by the names in the header, not by position; absent ones are NULL.

    Files of one table must agree on their header; one that differs raises.
    """
    texts = spark.read.options(
        header=True,
        enforceSchema=False,
        multiLine=True,
        quote='"',
        escape='"',
        emptyValue="",
        nullValue="\\N",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    found = set(texts.columns)
    return texts.select(
        *[
            F.col(f.name).try_cast(f.dataType).alias(f.name)
            if f.name in found
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def read_day(
    spark: SparkSession, path: str, schema: str, day: dt.date | None = None, fmt: str = "csv"
) -> DataFrame:
    """One day of a table, by default yesterday. An absent day raises ``NoData``."""
    wanted = day or dt.date.today() - dt.timedelta(1)
    df = read(spark, path, schema, wanted, wanted, fmt)
    if df.isEmpty():
        raise NoData(f"no data on {wanted} in {path}")
    return df


@dataclass(frozen=True)
class Drops:
    """The rows of some files, and those that were rejected: file, reason and cells."""

    rows: DataFrame
    rejected: DataFrame


def read_drops(
    spark: SparkSession, paths: str | list[str], schema: str, multi_line: bool = True, most_columns: int = 64
) -> Drops:
    """CSV files whose headers may differ in names and order, in one query.

    Every file's first row is its header and is joined to its rows by the file's name. A column that a file
    lacks is NULL there; columns that ``schema`` lacks are dropped. A row is rejected, with
    the reason, if it has more cells than its header or a value that its column's type can not
    hold. Only ``multi_line`` files may have line breaks in a cell, and then one task reads one
    file; others are split. A row that repeats its file's header counts as one.
    """
    wanted = StructType.fromDDL(schema)
    cells = [f"c{k}" for k in range(most_columns)]
    # Without a header of its own no row is taken for one by the reader.
    raw = spark.read.schema(", ".join(f"{c} string" for c in cells)).options(
        header=False, multiLine=multi_line, quote='"', escape='"', emptyValue="", nullValue="\\N",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(paths)
    named = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), F.array(*cells).alias("cells"))
    first = named.where("_start = 0").withColumn("_at", F.monotonically_increasing_id())
    headers = first.groupBy("file").agg(F.min_by("cells", "_at").alias("header"))
    headers = headers.select("file", "header", F.size(F.array_compact("header")).alias("_n"))
    met = named.join(headers, "file").where(~F.col("cells").eqNullSafe(F.col("header")))

    def value(name: str) -> Column:
        at = F.array_position("header", name)
        return F.when(at > 0, F.try_element_at("cells", F.greatest(at, F.lit(1)).cast("int")))

    bad = [F.when(value(f.name).isNotNull() & value(f.name).try_cast(f.dataType).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}")) for f in wanted]
    beyond = F.size(F.array_compact(F.slice("cells", F.col("_n") + 1, F.lit(most_columns)))) > 0
    reasons = F.array_compact(F.array(F.when(beyond, F.lit("more cells than the header")), *bad))
    judged = met.withColumn("_reasons", reasons)
    rows = judged.where(F.size("_reasons") == 0).select(*[value(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])
    rejected = judged.where(F.size("_reasons") > 0).select("file", F.array_join("_reasons", "; ").alias("reason"), F.array_compact("cells").alias("cells"))
    return Drops(rows, rejected)


def read_drop(spark: SparkSession, folder: str, schema: str, day: dt.date | None = None, multi_line: bool = True) -> Drops:
    """The one file of a day in a folder of dated files, by default yesterday's: ``NoData`` if there is none, ``SeveralDeliveries`` if two."""
    wanted = day or dt.date.today() - dt.timedelta(1)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*{wanted:%Y-%m-%d}*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = sorted(s.getPath().toString() for s in found)
    if not paths:
        raise NoData(f"no data on {wanted} in {folder}")
    if len(paths) > 1:
        raise SeveralDeliveries(f"{len(paths)} deliveries on {wanted} in {folder}")
    return read_drops(spark, paths, schema, multi_line)


def resolve_day(
    df: DataFrame,
    keys: list[str],
    wanted: dt.date,
    fallback: dt.date | None = None,
    latest: bool = False,
) -> DataFrame:
    """Each series' rows of one day: the wanted one, or a fallback where it is missing.

    With ``latest`` the fallback is the last day on or before the wanted one. The day is
    found by an aggregate over (series, date) and joined back, so a large series is not
    sorted. A series with neither day gives no rows.
    """
    if latest:
        near = df.where(F.col("date") <= F.lit(wanted))
    else:
        days = [wanted] if fallback is None else [wanted, fallback]
        near = df.where(F.col("date").isin(days))
    preferred = F.max("date")
    if not latest and fallback is not None:
        preferred = F.max_by("date", F.col("date") == F.lit(wanted))
    chosen = near.groupBy(*keys).agg(preferred.alias("date"))
    return near.join(chosen, [*keys, "date"], "left_semi")


def file_date(path: Column | None = None) -> Column:
    """Date in a file's path; use it on a file scan, where it reads the metadata column."""
    source = F.col("_metadata.file_path") if path is None else path
    return F.regexp_extract(source, DATE_PATTERN, 1).try_cast("date")
