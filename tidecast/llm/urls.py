"""URL filters: rules by host and path, and boosted trees on lexical features where no rule fits.

The trees learn from labelled URLs: those that a rule decides, or rows with labels of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "hyphens", "entropy",
    "parameters", "has_fragment", "suffix_rate", "suffix_weight",
]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_for(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule ``host/path`` whose host is the URL's or a parent of it, and whose path begins the URL's; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def lexical(df: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """``df`` with the lexical features of its URLs and ``_suffix``, the last part of the host."""
    whole = F.coalesce(F.col(url), F.lit(""))
    length = F.greatest(F.char_length(whole), F.lit(1))

    def count(text: Column, pattern: str) -> Column:
        return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))

    share = lambda c: (F.char_length(whole) - F.char_length(F.replace(whole, c, F.lit("")))) / F.char_length(c) / length
    distinct = F.filter(F.array_distinct(F.split(whole, "")), lambda c: c != "")
    entropy = F.aggregate(distinct, F.lit(0.0), lambda total, c: total - share(c) * F.log2(share(c)))
    query = F.regexp_extract(whole, r"(?s)\?([^#]*)", 1)
    values = {
        "url_length": F.char_length(whole),
        "host_length": F.char_length(host),
        "path_length": F.char_length(path),
        "depth": count(F.col(path), "/"),
        "host_labels": F.size(F.split(F.col(host), r"\.")),
        "digit_ratio": count(whole, "[0-9]") / length,
        "hyphens": count(whole, "-"),
        "entropy": entropy,
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "has_fragment": F.contains(whole, F.lit("#")),
    }
    named = {k: v.cast("double") for k, v in values.items()}
    return df.withColumns(named | {"_suffix": F.substring_index(F.col(host), ".", -1)})


def judge(
    pages: DataFrame,
    allow: Sequence[str],
    block: Sequence[str],
    key: str = "page_id",
    url: str = "url",
    sample: int = 20_000,
    trees: int = 10,
    depth: int = 4,
    label: str | None = None,
) -> DataFrame:
    """Per row: key, host, path, rule, verdict (allow or block) and ``block_score``.

    A rule decides where one fits; elsewhere the trees do. They learn from labelled URLs: the ones
    with a rule, or the rows where ``label`` is not null (1: block; a URL with several labels has
    that of most of its rows). At most ``sample`` distinct URLs, half of either label, of smallest
    hash are learned from; suffix statistics are counted over all labelled rows. Without labels
    of both kinds all other URLs are allowed. Null and
    malformed URLs have an empty host and path and go to the trees. Repeated rows are
    returned each; other columns are ignored.
    """
    rules = [*allow, *block]
    wanted = F.col(label).cast("double") if label else None
    rows = pages.select(
        F.col(key).alias("_key"), F.col(url).alias("_url"), *([wanted.alias("_label")] if label else [])
    )
    rows = rows.withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    rows = rows.withColumn("_rule", rule_for(F.col("_host"), F.col("_path"), rules))
    blocked = F.col("_rule").isin(list(block))
    if not label:
        rows = rows.withColumn("_label", F.when(F.col("_rule").isNotNull(), blocked.cast("double")))
    featured = lexical(rows, "_url", "_host", "_path")

    labelled = featured.where(F.col("_label").isNotNull()).select("_label", "_suffix", *FEATURES[:-2], "_url")
    rates = labelled.groupBy("_suffix").agg(F.sum("_label").alias("_bad"), F.count(F.lit(1)).alias("_seen"))
    rates = staged(rates, "suffixes")
    overall = rates.agg(F.sum("_bad") / F.sum("_seen")).first()[0]
    # Only URLs and their labels are grouped; features are computed again for those that are drawn.
    each = rows.where(F.col("_label").isNotNull()).groupBy("_url").agg((F.avg("_label") >= 0.5).cast("double").alias("_label"))
    each = each.where(F.col("_url").isNotNull())
    drawn = [each.where(F.col("_label") == k).orderBy(F.xxhash64("_url"), "_url").limit(max(1, sample // 2)) for k in (0.0, 1.0)]
    drawn = drawn[0].unionByName(drawn[1]).withColumns({"_host": host_of(F.col("_url")), "_path": path_of(F.col("_url"))})
    learned = staged(lexical(drawn, "_url", "_host", "_path").repartition(8).select("_label", "_suffix", *FEATURES[:-2]), "urls")
    kinds = learned.agg(F.count_distinct("_label")).first()[0]

    def with_suffix(df: DataFrame) -> DataFrame:
        seen = F.coalesce("_seen", F.lit(0))
        rate = (F.coalesce("_bad", F.lit(0.0)) + F.lit(10.0 * (overall or 0.0))) / (seen + 10)
        return df.join(rates, "_suffix", "left").withColumns({"suffix_rate": rate, "suffix_weight": F.log1p(seen.cast("double"))})

    if kinds == 2:
        steps = [
            VectorAssembler(inputCols=FEATURES, outputCol="_features"),
            GBTClassifier(
                labelCol="_label", featuresCol="_features", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=7
            ),
        ]
        model = Pipeline(stages=steps).fit(with_suffix(learned))
        judged = model.transform(with_suffix(featured))
        score = F.element_at(vector_to_array("probability"), 2)
    else:
        judged, score = featured, F.lit(0.0)
    verdict = F.when(F.col("_rule").isNotNull(), blocked).otherwise(score > 0.5)
    return judged.select(
        F.col("_key").alias(key),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.when(verdict, "block").otherwise("allow").alias("verdict"),
        score.alias("block_score"),
    )
