"""Best-fit packing of tokenized documents into sequences of a fixed capacity, in bulk-synchronous rounds.

Pieces are sorted by length and gaps by size. Lengths and gaps are whole numbers up to the
capacity, so either sorted list is kept as runs of equal values: at most ``capacity`` runs of
pieces, whatever the corpus holds. A round takes the longest run that is left and sweeps the
gaps upwards from its successor, the smallest gap it fits. All pieces of a run want the same
gaps; the conflict is resolved by rank: the piece of rank r takes the place r in the run of
gaps. Then the gaps are updated and the next round begins; a run that finds no successor opens
new sequences. The rounds only need the run lengths; the pieces themselves are ranked and
matched to their places where they are, in every task at once.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import arrow_types, columns_of, number_rows, record_batches, staged, word_ids

_RANK_BITS = 44


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Each document's ids and an end id, cut into pieces of at most ``capacity`` tokens.

    Returns key, piece, start, length, ids_crc32 and, if asked for, ``ids`` (little-endian
    unsigned 32-bit). A null text is empty: one piece that holds the end id.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    end, width = int(end_id).to_bytes(4, "little"), 4 * capacity

    types = arrow_types(schema)

    def cut(batches):
        def rows(encoder):
            for batch in columns_of(batches):
                for doc, ids in zip(batch["_key"], encoder.encode_all(t or "" for t in batch["_text"])):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), width)):
                        own = ids[at : at + width]
                        row = (doc, piece, at // 4, len(own) // 4, zlib.crc32(own))
                        yield (*row, own) if with_ids else row

        yield from record_batches(types, rows(word_ids(tokenizer)))

    return docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(cut, schema)


def plan(runs: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """The rounds over runs ``{length: count}``: blocks (length, first rank, per gap, first sequence, offset).

    Within a block, rank r lies in sequence ``first + (r - first rank) // per gap``.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    blocks: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def add(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, count))

    for length in sorted(runs, reverse=True):
        rank, left = 0, runs[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                fresh = -(-left // (capacity // length))
                add(capacity, opened, fresh)
                opened += fresh
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            each = gap // length
            full = min(count, left // each)
            rest = left - full * each if full < count else 0
            blocks.append((length, rank, each, first, capacity - gap))
            rank, left = rank + full * each + rest, left - full * each - rest
            add(gap - each * length, first, full)
            add(gap - rest * length, first + full, bool(rest))
            add(gap, first + full + bool(rest), count - full - bool(rest))
    return blocks


def pack(cut: DataFrame, capacity: int, order: list[str]) -> DataFrame:
    """``cut`` (from ``pieces``, or any rows with a ``length`` from 1 to ``capacity``) with sequence_id and offset.

    Every row is placed once; the places of a sequence have no gap before its end. Repeated
    rows get a place each. An empty table gives an empty result. ``order`` breaks ties
    between pieces of one length. Lengths outside the range raise.
    """
    fixed = staged(cut.withColumn("_part", F.spark_partition_id()), "pieces")
    runs = {r["length"]: r["n"] for r in fixed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if runs and not 0 < min(runs) <= max(runs) <= capacity:
        raise ValueError(f"lengths must be from 1 to {capacity}")
    blocks = np.array(sorted(plan(runs, capacity)), dtype="int64").reshape(-1, 5)
    starts = (blocks[:, 0] << _RANK_BITS) + blocks[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        found = blocks[np.searchsorted(starts, (length.to_numpy() << _RANK_BITS) + rank.to_numpy(), "right") - 1]
        within = rank.to_numpy() - found[:, 1]
        return pd.DataFrame(
            {
                "sequence_id": found[:, 3] + within // found[:, 2],
                "offset": found[:, 4] + within % found[:, 2] * found[:, 0],
            }
        )

    ranked = number_rows(fixed, ["length"], order, "_at").withColumn("_place", place("length", "_at"))
    return ranked.select(*cut.columns, "_place.sequence_id", "_place.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, length and ids, from pieces packed with their ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    joined = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("_parts"))
    return joined.select("sequence_id", "length", F.unhex(F.concat_ws("", "_parts.ids")).alias("ids"))
