"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import (
    audit,
    decontam,
    language,
    negatives,
    packing,
    quality,
    sharding,
    simhash,
    substring,
    suffixlm,
    tensored,
    tokenbin,
    urls,
)
from tidecast.llm.common import crc_of_id
from tidecast.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal weight, and their shard once there are 25."""
    return sharding.assign(_table(spark, sf_dir, "documents"), 24, 25)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    cut = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)
    return packing.pack(cut, 2048, ["doc_id", "piece"])


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with passages that lie in another one, or came before, cut out."""
    found = substring.dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "removed", F.size("removed").alias("n_removed"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains."""
    return decontam.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document, learned from those outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of_id("doc_id"), F.lit(7)) == 2
    tree, counts = suffixlm.train(docs, ~held_out)
    return suffixlm.score(docs, tree, counts, held_out)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and the verdict of every page's URL."""
    block = ["example.org/es/", "example.org/en/1", "com/de/"]
    return urls.judge(_table(spark, sf_dir, "pages"), ["org/", "com/fr/"], block)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base rules and the verdict of every document."""
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as files of directly addressable codes, read back per document."""
    path = scratch_dir(spark, "tokens")
    tokenbin.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return tokenbin.read(spark, path)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_of_id("doc_id"), F.lit(5)) == 0
    found = language.identify(docs, language.train(docs, ~held_out), keep={"held_out": held_out})
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep and remove in each of their orders, by language."""
    return audit.interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document at a similarity of 0.85."""
    return tensored.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector and its best rows of the same label."""
    vectors = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_suffix_lm": op5_suffix_lm,
    "op6_url_filter": op6_url_filter,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_token_file": op9_token_file,
    "op10_language": op10_language,
    "op11_filter_audit": op11_filter_audit,
    "op12_tensored_minhash": op12_tensored_minhash,
    "op13_hard_negatives": op13_hard_negatives,
}
_SHINGLES = """
    SELECT DISTINCT {id}, array_to_string(w[i:i+4], ' ') AS shingle
    FROM (
        SELECT {id}, w, unnest(range(1, len(w) - 3)) AS i
        FROM (
            SELECT {id}, list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
            FROM {table}
        )
    )
"""

SQL: dict[str, str] = {
    "op4_decontamination": f"""
WITH d AS ({_SHINGLES.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM d JOIN b USING (shingle) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles
HAVING count(*) >= 0.8 * n_shingles
""",
    "op11_filter_audit": r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text))::INT
        + 8 * regexp_matches(text, '[#$%&*|]')::INT
        + 16 * coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)::INT AS mask
    FROM w LEFT JOIN l USING (doc_id)
),
m AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM f GROUP BY part, mask
),
o AS (
    SELECT '' AS done, 0 AS step, NULL::INT AS bit, 0 AS mask
    UNION ALL
    SELECT done || chr(65 + k::INT), step + 1, (1 << k)::INT, (mask | (1 << k))::INT
    FROM o, range(5) AS t(k) WHERE mask & (1 << k) = 0
),
s AS (
    SELECT whole.done AS filter_order, o.step, o.bit, o.mask & ~o.bit AS earlier, o.mask AS later
    FROM o JOIN o AS whole ON whole.step = 5 AND o.step > 0 AND starts_with(whole.done, o.done)
),
c AS (
    SELECT part, filter_order, step, chr(65 + log2(bit)::INT) AS filter,
        sum(CASE WHEN m.mask & later = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN m.mask & later = bit THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN m.mask & bit <> 0 AND m.mask & earlier <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN m.mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN m.mask & later = bit THEN n_good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN m.mask & later = bit THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM m, s GROUP BY part, filter_order, step, bit
)
SELECT *, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley FROM c
""",
    "op13_hard_negatives": """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e AS a JOIN e AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
""",
}
