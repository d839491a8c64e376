"""Sharding by weighted rendezvous hashing of record keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import number_rows, staged


def shard_of(key: str | Column, shards: int | Mapping[int, float]) -> Column:
    """The shard that wins the rendezvous for a key.

    Each shard draws ``-weight / ln(u)``, where ``u`` in (0, 1) comes from a hash of key and
    shard alone; the largest draw wins, the smaller number on a tie. A shard that is added
    can only win keys for itself, and one that leaves only gives up its own. Keys are hashed
    as text, so their integer width does not matter. Null keys form one key.
    """
    weights = dict.fromkeys(range(shards), 1.0) if isinstance(shards, int) else dict(shards)
    if not weights or min(weights.values()) <= 0:
        raise ValueError("at least one shard, and only positive weights")
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    draws = []
    for shard, weight in sorted(weights.items()):
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(int(shard))), 11) + F.lit(0.5)) / F.lit(2.0**53)
        draws.append(F.struct((F.lit(-float(weight)) / F.ln(u)).alias("draw"), F.lit(-int(shard)).alias("shard")))
    return -F.array_max(F.array(*draws))["shard"]


def assign(
    docs: DataFrame,
    shards: int | Mapping[int, float],
    grown: int | Mapping[int, float] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text plus 8 (a null text has length 0 and the crc32 of
    no bytes). ``slot`` numbers the rows of a shard from 0 without gaps; it follows the
    input's splits, the shard follows the key alone. ``grown_shard`` is the shard under
    ``grown`` (null when not given). Repeated rows keep a slot each; an empty table gives an
    empty result; all other columns are ignored.

    Only these narrow rows are shuffled, never the texts.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias(key),
        (F.octet_length(whole) + F.lit(8)).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, shards).cast("int").alias("shard"),
        (shard_of(key, grown) if grown is not None else F.lit(None)).cast("int").alias("grown_shard"),
        F.spark_partition_id().alias("_part"),
    )
    numbered = number_rows(staged(narrow, "shards"), ["shard"], [key, "text_crc32", "size"], "slot")
    return numbered.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
