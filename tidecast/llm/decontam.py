"""Benchmark decontamination: containment search by MinHash, partitioned by size, and exact verification.

A benchmark item is contained in a document if the document holds at least ``threshold`` of
the item's distinct five-word shingles. The items are partitioned by their number of shingles.
Each item is sketched by its shingles of smallest hash, one more than it may lack: for a
partition of up to u shingles, floor((1 - threshold) * u) + 1 of them. A document that holds
none of these lacks too many, whatever its own length, so the search misses nothing; a Jaccard
signature of the document would drown a short item. Candidates are verified by counting the
shared shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import staged

SHINGLE = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(size: int = SHINGLE) -> Column:
    """The distinct shingles of ``_words``, as strings; none if there are fewer words."""
    own = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("_words") - (size - 1), F.lit(1))),
        lambda i: F.array_join(F.slice(F.col("_words"), i, size), " "),
    )
    return F.when(F.size("_words") >= size, F.array_distinct(own)).otherwise(F.array().cast("array<string>"))


def exploded(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, shingle): a row for each distinct shingle of a row.

    The outer form of explode keeps Spark from testing the list for emptiness first, which
    would split the text anew for every shingle.
    """
    held = df.select(F.col(key).alias("id"), words(F.col(text)).alias("_words"))
    held = held.select("id", F.explode_outer(shingles()).alias("shingle"))
    return held.where(F.col("shingle").isNotNull())


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Pairs (key, item) with n_shingles, n_shared and containment, for containments of at least ``threshold``.

    Items of fewer than five words have no shingle and match nothing, as do null and empty
    texts; rows with a null id match nothing either. Rows that repeat an id count as one whose
    shingles are all theirs together. An empty table gives no pair; other columns are ignored.

    Whether the items' tables are broadcast is left to Spark's check of their written size;
    otherwise both sides are shuffled by shingle. Only matches are grouped.
    """
    own = exploded(items.where(F.col(item).isNotNull()), item, item_text).distinct()
    sized = own.join(own.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "id")
    least = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("shingle"), "shingle"))
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("n")))
    lacks = F.floor(F.lit(1 - threshold) * upper + F.lit(1e-9)) + 1
    benchmark = staged(
        sized.select(F.col("id").alias("item"), "shingle", "n", (least <= lacks).alias("in_sketch")), "benchmark"
    )
    sketch = staged(benchmark.where("in_sketch").select("item", "shingle"), "sketch")

    narrow = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    held = exploded(narrow, "_key", "_text").select(F.col("id").alias("doc"), "shingle")
    candidates = staged(held.join(sketch, "shingle").select("doc", "item").distinct(), "candidates")
    found = narrow.join(candidates.select(F.col("doc").alias("_doc")).distinct(), F.col("_key") == F.col("_doc"), "left_semi")
    held = exploded(found, "_key", "_text").select(F.col("id").alias("doc"), "shingle")
    shared = held.join(benchmark, "shingle").groupBy("doc", "item", "n").agg(F.count_distinct("shingle").alias("n_shared"))
    sure = shared.join(candidates, ["doc", "item"]).where(F.col("n_shared") >= F.lit(threshold) * F.col("n") - F.lit(1e-9))
    return sure.select(
        F.col("doc").alias(key),
        F.col("item").alias(item),
        F.col("n").cast("long").alias("n_shingles"),
        "n_shared",
        (F.col("n_shared") / F.col("n")).alias("containment"),
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with all their columns."""
    leaks = staged(search(docs, items, key, text, **options).select(F.col(key).alias("_leak")).distinct(), "leaks")
    return docs.join(leaks, docs[key] == leaks["_leak"], "left_anti")
