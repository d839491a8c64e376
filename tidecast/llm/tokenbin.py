"""Token ids in files of directly addressable codes.

A file row is a segment: the ids of some consecutive documents. Each id is split into bytes,
lowest first. Level k holds byte k of those ids that need it, a bitmap that says which of
them continue on the next level, and a rank directory: the number of set bits before every
512th. A token is read by one byte and one rank per level; nothing around it is decoded.

Payload of a segment, little-endian: ``DAC1``, levels (u32), ids (u64), then for each level
its entries (u64), directory (u32 each), bitmap (lowest bit first) and bytes. The rows lie in
Parquet files, so any store that Spark reaches will do; ``segments`` holds them in document
order of (part, segment), ``index`` the number of ids before each.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidecast.llm.common import arrow_types, columns_of, map_rows, record_batches, word_ids

MAGIC = b"DAC1"
STEP = 512


def encode(ids: np.ndarray) -> bytes:
    """The payload of one segment."""
    levels, rest = [], ids.astype("<u4")
    while len(rest) or not levels:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little").tobytes()
        ones = np.add.reduceat(more, np.arange(0, len(more), STEP), dtype="u4") if len(more) else np.zeros(0, "u4")
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else ones
        levels.append(struct.pack("<Q", len(rest)) + ranks.tobytes() + bitmap + (rest & 0xFF).astype("u1").tobytes())
        rest = rest[more] >> 8
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class Segment:
    """A payload, opened without decoding it."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        levels, self.size = struct.unpack_from("<IQ", payload, 4)
        self.levels, at = [], 16
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            ranks, bits = -(-n // STEP), -(-n // 8)
            self.levels.append(
                (
                    np.frombuffer(payload, "<u4", ranks, at + 8),
                    np.frombuffer(payload, "u1", bits, at + 8 + 4 * ranks),
                    np.frombuffer(payload, "u1", n, at + 8 + 4 * ranks + bits),
                )
            )
            at += 8 + 4 * ranks + bits + n

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, at: int | slice) -> int | np.ndarray:
        if isinstance(at, slice):
            start, stop, step = at.indices(self.size)
            return self._read(0, start, max(start, stop))[::step] if step > 0 else self._read(0, 0, self.size)[at]
        if not -self.size <= at < self.size:
            raise IndexError(at)
        return int(self._read(0, at % self.size, at % self.size + 1)[0])

    def _read(self, level: int, start: int, stop: int) -> np.ndarray:
        ranks, bitmap, low = self.levels[level]
        ids = low[start:stop].astype("<u4")
        if level + 1 < len(self.levels) and stop > start:
            block = start // STEP
            bits = np.unpackbits(bitmap[block * STEP // 8 : -(-stop // 8)], bitorder="little")
            own = bits[start - block * STEP : stop - block * STEP].astype(bool)
            first = int(ranks[block]) + int(bits[: start - block * STEP].sum())
            ids[own] |= self._read(level + 1, first, first + int(own.sum())) << np.uint32(8)
        return ids


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    segment_tokens: int = 1 << 16,
) -> None:
    """Encode all documents and write their ids in ascending order of ``key``.

    Each document's ids are followed by ``end_id``; a null text is empty. Null keys come
    first; rows that share a key are all written, in order of a hash of their text. A segment
    is closed at the document that brings it to ``segment_tokens``, so a document is never
    split. An empty table gives empty files. Other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"part int, segment int, n_tokens long, keys array<{kind}>, lengths array<long>, payload binary"
    types = arrow_types(schema)
    end = int(end_id).to_bytes(4, "little")
    rows = docs.select(
        F.col(key).alias("_key"),
        F.col(text).alias("_text"),
        F.xxhash64(text).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )
    order = ["_key", "_hash", "_row"]

    def segments(batches):
        part, number = TaskContext.get().partitionId(), 0
        keys, ids, held = [], [], 0

        def closed():
            lengths = [len(x) // 4 for x in ids]
            return part, number, held, list(keys), lengths, encode(np.frombuffer(b"".join(ids), "<u4"))

        def every(encoder):
            nonlocal keys, ids, held, number
            for columns in columns_of(batches):
                for doc, own in zip(columns["_key"], encoder.encode_all(t or "" for t in columns["_text"])):
                    keys.append(doc)
                    ids.append(own + end)
                    held += len(ids[-1]) // 4
                    if held >= segment_tokens:
                        yield closed()
                        keys, ids, held, number = [], [], 0, number + 1
            if keys:
                yield closed()

        yield from record_batches(types, every(word_ids(tokenizer)), 32)

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_key", "_text")
    ordered.mapInArrow(segments, schema).write.parquet(f"{path}/segments")
    spark = docs.sparkSession
    sizes = spark.read.parquet(f"{path}/segments").select("part", "segment", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.withColumn("_own", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    index = own.join(parts, "part").select("part", "segment", (F.col("_before") + F.col("_own")).alias("first"), "n_tokens")
    index.write.parquet(f"{path}/index")


def read(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files at ``path``: key, start, n_tokens and ids_crc32, from the ids as they are read."""
    segments = spark.read.parquet(f"{path}/segments")
    kind = segments.schema["keys"].dataType.elementType.simpleString()
    schema = f"part int, segment int, `{key}` {kind}, _own long, n_tokens long, ids_crc32 long"

    def rows(batch):
        for part, segment, keys, lengths, payload in zip(*(batch[c] for c in ("part", "segment", "keys", "lengths", "payload"))):
            opened, at = Segment(payload), 0
            for doc, length in zip(keys, lengths):
                yield part, segment, doc, at, length, zlib.crc32(opened[at : at + length].tobytes())
                at += length

    docs = map_rows(segments.select("part", "segment", "keys", "lengths", "payload"), schema, rows)
    index = spark.read.parquet(f"{path}/index").select("part", "segment", "first")
    return docs.join(index, ["part", "segment"]).select(
        key, (F.col("first") + F.col("_own")).alias("start"), "n_tokens", "ids_crc32"
    )
