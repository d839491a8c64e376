"""From classified texts to one sentiment row per series and day."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.functions import scoring, text
from tidecast.operators.skew import top_n_per_group

PAD_ID, UNKNOWN_ID, SEPARATOR_ID, FIRST_WORD_ID = 0, 1, 2, 3
SEQUENCE_LENGTH = 128


def content(df: DataFrame, untitled: list[str] | None = None) -> DataFrame:
    """``title + ' ' + article``, or the article where the source has no titles.

    A table of several sources names those without titles in ``untitled``. Elsewhere a
    NULL title gives NULL content, so ``concat`` and not ``concat_ws``.
    """
    if "title" not in df.columns:
        return df.withColumn("content", F.col("article"))
    both = F.concat("title", F.lit(" "), "article")
    if untitled:
        both = F.when(F.col("media").isin(untitled), F.col("article")).otherwise(both)
    return df.withColumn("content", both)


def sample_per_day(
    df: DataFrame, keys: list[str], n: int, row_id: str, seed: int = 42
) -> DataFrame:
    """At most ``n`` rows per group and day, uniform, without replacement, repeatable.

    The order is a hash of the row id, so a retried task draws the same rows. Ids are ranked
    without the rest of their rows; the chosen ids then fetch the rows by a semi-join. A row
    id is unique, so neither step depends on how large a day is, and no text is moved by day.
    """
    order = F.md5(F.concat(F.lit(f"{seed}-"), F.col(row_id).cast("string")))
    ids = df.select(*keys, "date", row_id)
    chosen = top_n_per_group(ids, [*keys, "date"], [order, F.col(row_id)], n, row_id)
    return df.join(chosen.select(row_id), row_id, "left_semi").select(*df.columns)


def expand_aspects(
    df: DataFrame,
    symbol: str = "btc",
    name: str = "bitcoin",
    aspects: list[str] = scoring.ASPECTS,
) -> DataFrame:
    """One row per (text, aspect) with its pseudo-sentence. A narrow ``explode``."""
    listed = F.array(*[F.lit(a) for a in aspects])
    sentence = F.concat(F.lit(f"{symbol} - {name} - "), F.lower("aspect"))
    return df.withColumn("aspect", F.explode(listed)).withColumn("pseudo_sentence", sentence)


def counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Documents per (series, day, aspect, polarity)."""
    return df.groupBy(*keys, "date", "aspect", "polarity").agg(F.count("*").alias("n"))


def _count_where(condition: Column, weight: Column | None = None) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.lit(1) if weight is None else weight)), F.lit(0))


def records(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """``(date, total_docs, sentiment)`` with ``sentiment`` a map aspect -> polarity -> n.

    All aspects are present; a polarity that was not seen is absent. The fifteen counts
    are plain sums in one aggregation, so nothing is collected per group.
    """
    amount = F.col(weight) if weight else None
    cells = [
        _count_where((F.col("aspect") == a) & (F.col("polarity") == p), amount).alias(f"{a}_{p}")
        for a in scoring.ASPECTS
        for p in scoring.POLARITIES
    ]
    total = F.sum(weight) if weight else F.count("*")
    wide = df.groupBy(*keys, "date").agg(total.alias("total_docs"), *cells)

    def seen(aspect: str) -> Column:
        pairs = [x for p in scoring.POLARITIES for x in (F.lit(p), F.col(f"{aspect}_{p}"))]
        return F.map_filter(F.create_map(*pairs), lambda _, n: n > 0)

    nested = F.create_map(*[x for a in scoring.ASPECTS for x in (F.lit(a), seen(a))])
    return wide.select(*keys, "date", "total_docs", nested.alias("sentiment"))


def flatten_records(df: DataFrame, keys: list[str], carry: list[str] | None = None) -> DataFrame:
    """Sentiment maps back to long rows ``(keys, date, aspect, polarity, n)``, with the columns ``carry``."""
    held = [*keys, "date", *(carry or [])]
    by_aspect = df.select(*held, F.explode("sentiment").alias("aspect", "_polarities"))
    return by_aspect.select(*held, "aspect", F.explode("_polarities").alias("polarity", "n"))


def polarity_totals(df: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """Documents per polarity over all aspects, one row per series and day.

    ``weight`` names a count column when ``df`` holds counts rather than documents.
    """
    amount = F.col(weight) if weight else None
    totals = [
        _count_where(F.col("polarity") == p, amount).alias(f"total_{p.lower()}")
        for p in scoring.POLARITIES
    ]
    return df.groupBy(*keys, "date").agg(*totals)


def source_features(posts: DataFrame, keys: list[str], sources: list[str]) -> DataFrame:
    """Score, log ratio, totals and document count of every source, in one aggregation.

    One pass and one shuffle serve all sources: each is a conditional sum, so a source
    that holds most of the rows does not make one reducer larger than the others. A
    source without documents on a day leaves NULLs, like a missing daily file.
    """
    is_polarity = {p: F.col("polarity") == p for p in scoring.POLARITIES}
    sums = []
    for s in sources:
        of_source = F.col("media") == s
        sums.append(F.count_if(of_source).alias(f"total_docs_{s}"))
        sums += [
            F.count_if(of_source & is_polarity[p]).alias(f"total_{p.lower()}_{s}")
            for p in scoring.POLARITIES
        ]
    daily = posts.groupBy(*keys, "date").agg(*sums)
    columns = []
    for s in sources:
        seen = F.col(f"total_docs_{s}") > 0
        positive, negative, none = [F.col(f"total_{p.lower()}_{s}") for p in scoring.POLARITIES]
        shown = {
            f"{s}_score": scoring.polarity_score(positive, negative, none),
            f"{s}_pos_neg_ratio": scoring.pos_neg_ratio(positive, negative),
            f"total_positive_{s}": positive,
            f"total_negative_{s}": negative,
            f"total_docs_{s}": F.col(f"total_docs_{s}"),
        }
        columns += [F.when(seen, c).alias(name) for name, c in shown.items()]
    return daily.select(*keys, "date", *columns)


def lexicon_polarity(
    df: DataFrame, row_id: list[str], lexicon: DataFrame, text_col: str = "content"
) -> DataFrame:
    """Polarity of every (text, aspect) by the sign of its summed word weights.

    ``lexicon`` has (token, aspect, weight); it is turned into one row per token, so the
    join never multiplies tokens. Tokens of one text are exploded and summed in the same
    task, so the shuffle carries about one row per text.
    """
    weights = lexicon.groupBy("token").agg(
        *[F.sum(F.when(F.col("aspect") == a, F.col("weight"))).alias(a) for a in scoring.ASPECTS]
    )
    words = df.select(*row_id, F.explode_outer(text.tokens(F.lower(text_col))).alias("token"))
    sums = [F.coalesce(F.sum(a), F.lit(0)).alias(a) for a in scoring.ASPECTS]
    per_text = words.join(weights, "token", "left").groupBy(*row_id).agg(*sums)
    pairs = F.array(
        *[F.struct(F.lit(a).alias("aspect"), F.col(a).alias("score")) for a in scoring.ASPECTS]
    )
    label = (
        F.when(F.col("score") > 0, "POSITIVE").when(F.col("score") < 0, "NEGATIVE").otherwise("NONE")
    )
    return per_text.select(*row_id, F.inline(pairs)).withColumn("polarity", label)


def build_vocab(df: DataFrame, size: int, text_col: str = "content") -> DataFrame:
    """The ``size`` most frequent tokens with ids; ties go by the token.

    Counting is combined before the shuffle, so a token in every text is no hot key.
    Ids are numbered after the limit, over ``size`` rows at most.
    """
    words = df.select(F.explode(text.tokens(F.lower(text_col))).alias("token"))
    common = (
        words.groupBy("token")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(size)
    )
    position = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    return common.select(
        "token", "n", (position - 1 + FIRST_WORD_ID).cast("long").alias("token_id")
    )


def encode(
    df: DataFrame,
    row_id: str,
    vocab: DataFrame,
    length: int = SEQUENCE_LENGTH,
    text_col: str = "content",
    pair_col: str | None = None,
) -> DataFrame:
    """Token ids of fixed length with a mask: ``(row_id, input_ids, attention_mask)``.

    Texts are cut to ``length`` tokens, as the model's input is. A pair text follows a
    separator and keeps its tokens; the first text gives way.
    """
    first = text.tokens(F.lower(text_col), length)
    if pair_col is None:
        cut = first
    else:
        second = text.tokens(F.lower(pair_col), length - 1)
        room = F.greatest(F.lit(length - 1) - F.size(second), F.lit(0))
        cut = F.concat(F.slice(first, 1, room), F.array(F.lit(None).cast("string")), second)
    words = df.select(row_id, F.posexplode_outer(cut).alias("_at", "token"))
    known = words.join(vocab.select("token", "token_id"), "token", "left")
    token_id = F.when(
        F.col("_at").isNotNull(),
        F.coalesce(
            F.col("token_id"),
            F.when(F.col("token").isNull(), F.lit(SEPARATOR_ID)).otherwise(F.lit(UNKNOWN_ID)),
        ),
    )
    placed = known.groupBy(row_id).agg(
        F.sort_array(
            F.collect_list(
                F.when(F.col("_at").isNotNull(), F.struct("_at", token_id.alias("token_id")))
            )
        ).alias("_placed")
    )
    found = F.col("_placed.token_id")

    def padded(values: Column) -> Column:
        empty = F.array_repeat(F.lit(PAD_ID).cast("long"), length)
        return F.slice(F.concat(values, empty), 1, length)

    return placed.select(
        row_id,
        padded(found).alias("input_ids"),
        padded(F.transform(found, lambda _: F.lit(1).cast("long"))).alias("attention_mask"),
    )


def batch_infer(
    df: DataFrame,
    load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: str,
    batch_size: int | None = None,
) -> DataFrame:
    """Score rows with any Python model, ``batch_size`` at a time (None: whole Arrow batches).

    ``load`` runs once per task and returns the function applied to every batch, so a
    network's weights are read once and not per batch. Workers must be able to import what
    it refers to, or it must be defined inside a function and so travel whole.
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            size = batch_size or max(1, len(batch))
            for at in range(0, len(batch), size):
                yield predict(batch.iloc[at : at + size])

    return df.mapInPandas(score, schema)
