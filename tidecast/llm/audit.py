"""How the filters of a corpus interact: what every order of applying them keeps, removes and would have removed anyway.

Each filter stores one table of the ids that fail it. A prefix of an order is judged by the
set of filters in it, so ``2^k`` prefix sets stand for all orders. Everything follows from
anti- and semi-joins with the stored tables:

* survivors of a prefix: all rows, anti-joined with the failing ids of the prefix's filters;
* removed by the next filter: its failing ids, anti-joined with those of the prefix;
* redundant: its failing ids, semi-joined with those of the prefix.

The prefix sets are a column: rows are shuffled once by id and repeated for the sets behind the
shuffle, so one join answers for all prefixes and its tasks read no more than the narrow ids.
Ids are spread evenly whatever source, language or text is frequent, and counts are combined
before they are shuffled by part.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import SPACE, staged
from tidecast.operators.skew import spread_join
from tidecast.session import scratch_dir

MOST_FILTERS = 6
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_filters(text: str = "text") -> dict[str, Column]:
    """Four filters on whole texts; a null text is empty. True: the row fails.

    A: fewer than 200 words. B: less than half of the words are distinct. C: more than 3 % of
    the code points are A-Z. D: holds one of ``#$%&*|``.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(whole, SPACE), "")
    capitals = F.char_length(F.regexp_replace(whole, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.lit(100) * F.size(F.array_distinct(words)) < F.lit(50) * F.size(words),
        "C": F.lit(100) * capitals > F.lit(3) * F.char_length(whole),
        "D": whole.rlike("[#$%&*|]"),
    }


def _numbered(docs: DataFrame, filters: Mapping[str, Column], repeats: str | None, key: str, text: str, part: str) -> DataFrame:
    """Every row under a number of its own, with key, part and its failed filters, staged.

    The number is fixed by the write; it tells rows of one key, or without a key, apart.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    failed = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in filters.items()]).cast("array<string>"))
    digest = F.unhex(F.sha2(whole.cast("binary"), 256)) if repeats else F.lit(None).cast("binary")
    return staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key).alias("key"),
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            failed.alias("failed"),
            digest.alias("digest"),
        ),
        "audit-rows",
    )


def failing_ids(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column],
    repeats: str | None,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    quality: str = "quality",
    toxic: str = "toxic",
) -> tuple[DataFrame, DataFrame]:
    """All rows (row, key, part), and the stored failing ids, one table (Parquet partition) per ``filter``.

    A failing id is (row, key, part, good, toxic); the flags come from ``labels`` (quality 1,
    toxic 1). ``repeats`` names the filter that rows fail whose text a smaller key has too:
    the smallest key of each text is anti-joined by text digest and key, so no frequent text
    meets in one task. A row without a key never fails it and has no label.
    """
    rows = _numbered(docs, filters, repeats, key, text, part)
    fails = rows.select("row", "key", "part", F.explode("failed").alias("filter"))
    if repeats:
        first = rows.groupBy("digest").agg(F.min("key").alias("key"))
        later = rows.where(F.col("key").isNotNull()).join(first, ["digest", "key"], "left_anti")
        fails = fails.unionByName(later.select("row", "key", "part", F.lit(repeats).alias("filter")))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_label_key"))
    known = known.agg(F.max((F.col(quality) == 1).cast("long")).alias("good"), F.max((F.col(toxic) == 1).cast("long")).alias("toxic"))
    fails = spread_join(fails, known, "key", "_label_key", "row").fillna(0, ["good", "toxic"])
    path = scratch_dir(docs.sparkSession, "failing-ids")
    fails.write.partitionBy("filter").parquet(path)
    stored = docs.sparkSession.read.schema(fails.schema).parquet(path)
    return rows.select("row", "key", "part"), stored


def prefix_counts(rows: DataFrame, fails: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Per part and prefix set: ``kept``; and per part, prefix set and next filter: removed, redundant, good_lost, toxic_lost.

    Sets and filters are bits in the order of ``names``.
    """
    sets = F.array(*[F.lit(s) for s in range(1 << len(names))])
    bits = F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n), F.lit(1 << k))])
    fails = fails.withColumn("bit", bits[F.col("filter")])
    others = fails.select(F.col("row").alias("_row"), F.col("bit").alias("_bit")).repartition("_row").hint("shuffle_hash")
    failed_before = (F.col("row") == F.col("_row")) & (F.col("before").bitwiseAND(F.col("_bit")) != 0)

    alive = rows.select("row", "part").repartition("row").select("*", F.explode(sets).alias("before"))
    kept = alive.join(others, failed_before, "left_anti").groupBy("part", "before").agg(F.count(F.lit(1)).alias("kept"))

    without = F.filter(sets, lambda s: s.bitwiseAND(F.col("bit")) == 0)
    next_up = fails.select("row", "part", "bit", "good", "toxic").repartition("row").select("*", F.explode(without).alias("before"))
    removed = next_up.join(others, failed_before, "left_anti").groupBy("part", "before", "bit")
    removed = removed.agg(F.count(F.lit(1)).alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
    redundant = next_up.join(others, failed_before, "left_semi").groupBy("part", "before", "bit")
    redundant = redundant.agg(F.count(F.lit(1)).alias("redundant"))
    return kept, removed.join(redundant, ["part", "before", "bit"], "full").fillna(0)


def interactions(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    repeats: str | None = "E",
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """One row per part, order of the filters (their names in a row) and step (from 1): the counts, and the step's ``filter``.

    kept: rows left after the step; removed: rows it takes; redundant: rows that fail its
    filter and were taken before; unique_fails: rows that fail its filter alone; good_lost,
    toxic_lost: removed rows by label; shapley: rows its filter removes, summed over all
    orders. Every part has a row for each order and step, zeros included.

    A null part is the empty string; a null text is empty; a filter that gives null does not
    fail. Repeated rows and rows without a key count one by one (``failing_ids`` says which
    labels they have and when they repeat). A key labelled twice is good or toxic if any label
    says so. An empty table gives no rows, an empty label table zeros. Other columns are
    ignored. At most ``MOST_FILTERS`` filters: the result has a row for each order of them.
    """
    filters = text_filters(text) if filters is None else filters
    names = [*filters, *([repeats] if repeats else [])]
    if not 0 < len(names) <= MOST_FILTERS or len(set(names)) < len(names):
        raise ValueError(f"from 1 to {MOST_FILTERS} filters of different names")
    rows, fails = failing_ids(docs, labels, filters, repeats, key, text, part)
    kept, steps = (staged(df, "audit-counts") for df in prefix_counts(rows, fails, names))

    orders = F.array(
        *[
            F.struct(
                F.lit("".join(names[k] for k in order)).alias("filter_order"),
                F.array(*[F.lit(1 << k) for k in order]).alias("bits"),
                F.array(*[F.lit(names[k]) for k in order]).alias("names"),
            )
            for order in permutations(range(len(names)))
        ]
    )
    every = kept.select("part").distinct().select("part", F.inline(orders))
    every = every.select("part", "filter_order", "names", "bits", F.posexplode("bits").alias("_at", "bit"))
    before = F.aggregate(F.slice("bits", 1, F.col("_at")), F.lit(0), lambda done, bit: done.bitwiseOR(bit))
    every = every.select(
        "part",
        "filter_order",
        (F.col("_at") + 1).cast("int").alias("step"),
        F.element_at("names", F.col("_at") + 1).alias("filter"),
        "bit",
        before.alias("before"),
    ).withColumn("after", F.col("before").bitwiseOR(F.col("bit")))
    whole = (1 << len(names)) - 1
    alone = steps.where(F.col("before").bitwiseOR(F.col("bit")) == whole).select("part", "bit", F.col("removed").alias("unique_fails"))
    found = (
        every.join(kept.withColumnRenamed("before", "after"), ["part", "after"], "left")
        .join(steps, ["part", "before", "bit"], "left")
        .join(alone, ["part", "bit"], "left")
        .fillna(0)
    )
    found = found.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit")))
    return found.select("part", "filter_order", "step", *COUNTS, "filter")
