"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 16 bytes decides where a chunk ends: at white space, and between
characters in scripts without spaces or where no white space came for 48 bytes. Cuts depend on the
last bytes alone: there is no smallest or largest size, so an insertion moves no cut beyond its
neighbourhood. What is compared by digest are runs of consecutive chunks: from each chunk's start,
and back from each chunk's end, the shortest that reaches the least length. A run is a repeat if
its text came earlier in the document or lies in a document of smaller rank; repeats are removed.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidecast.llm.common import forget_words, release, staged

WINDOW = 16
#: One white space in so many ends a chunk.
SPACES_PER_CUT = 4
#: So many bytes without white space may be cut between characters; one place in so many is, by bytes of the character before it.
UNBROKEN = 48
CHARS_PER_CUT = (24, 8)
MIN_BYTES = 80


def _gears() -> np.ndarray:
    """A 32-bit number for each byte, from a 64-bit mixing function."""
    with np.errstate(over="ignore"):
        x = (np.arange(256, dtype="uint64") + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(32)).astype("uint32")


GEARS = _gears()
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BLOCK = 1 << 20


def _unspaced(lead: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether three-byte characters are kana or ideographs, or Thai, Lao, Burmese or Khmer."""
    southern = ((lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)) | (
        (lead == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    )
    return ((lead >= 0xE3) & (lead <= 0xE9)) | southern


def cuts(text: bytes) -> np.ndarray:
    """The ends of a text's chunks, the last one at its end."""
    ends = []
    for start in range(0, len(text), _BLOCK):
        lead = min(start, UNBROKEN)
        own = np.frombuffer(text, "u1", min(len(text), start + _BLOCK + 1) - start + lead, start - lead)
        rolled = GEARS[own]
        for width in (1, 2, 4, 8):
            shifted = rolled[:-width] << np.uint32(width)
            rolled[width:] += shifted
        drawn = (rolled >> np.uint32(16))[lead : lead + _BLOCK]
        end = _SPACE[own[lead : lead + _BLOCK]] & (drawn % np.uint32(SPACES_PER_CUT) == 0)
        narrow, wide = (drawn % np.uint32(n) == 0 for n in CHARS_PER_CUT)
        some = np.flatnonzero(narrow | wide)
        some = some[some + start + 1 < len(text)]
        at = some + lead
        some, at = (x[((own[at + 1] & 0xC0) != 0x80) & ~_SPACE[own[at]]] for x in (some, at))
        spaces = np.concatenate([[0], np.cumsum(_SPACE[own])])
        unbroken = (at + 1 >= UNBROKEN) & (spaces[at + 1] == spaces[np.maximum(at + 1 - UNBROKEN, 0)])
        many = own[at] >= 0x80
        unspaced = many & (at >= 2) & _unspaced(own[np.maximum(at - 2, 0)], own[np.maximum(at - 1, 0)])
        end[some[(unbroken & ~many & narrow[some]) | ((unbroken | unspaced) & many & wide[some])]] = True
        ends.append(np.flatnonzero(end) + start + 1)
    found = np.concatenate(ends) if ends else np.zeros(0, "int64")
    return found if len(found) and found[-1] == len(text) else np.append(found, len(text)).astype("int64")


def chunks(text: str | None) -> tuple[bytes, np.ndarray, list[int]]:
    """UTF-8 bytes, chunk ends and chunk digests (signed 64-bit) of a text."""
    import xxhash

    own = (text or "").encode("utf-8", "replace")
    if not own:
        return own, np.zeros(0, "int64"), []
    ends = cuts(own)
    digest, at = xxhash.xxh3_64_intdigest, ends.tolist()
    found = [digest(own[a:b]) for a, b in zip([0, *at[:-1]], at)]
    return own, ends, np.array(found, "uint64").view("int64").tolist()


def runs(text: str | None, min_bytes: int = MIN_BYTES) -> tuple[bytes, np.ndarray, np.ndarray, list[int]]:
    """UTF-8 bytes and chunk ends of a text; first and last chunk, and digest, of its shortest runs of ``min_bytes``, in order."""
    import xxhash

    own = (text or "").encode("utf-8", "replace")
    if len(own) < max(1, min_bytes):
        return own, np.array([len(own)]), np.zeros((0, 2), "int64"), []
    ends = cuts(own)
    starts, count = np.concatenate([[0], ends[:-1]]), len(ends)
    last = np.searchsorted(ends, starts + min_bytes)
    first = np.searchsorted(starts, ends - min_bytes, side="right") - 1
    forward, back = np.flatnonzero(last < count), np.flatnonzero(first >= 0)
    codes = np.unique(np.concatenate([forward * count + last[forward], first[back] * count + back]))
    spans = np.stack([codes // count, codes % count], axis=1)
    digest = xxhash.xxh3_64_intdigest
    found = [digest(own[a:b]) for a, b in zip(starts[spans[:, 0]].tolist(), ends[spans[:, 1]].tolist())]
    return own, ends, spans, np.array(found, "uint64").view("int64").tolist()


def removed_spans(
    ends: np.ndarray, digests: list[int], repeats: set[int], min_bytes: int, spans: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Byte spans of the stretches of repeats that reach ``min_bytes``.

    ``spans`` has the first and last chunk that each digest stands for (None: one chunk each).
    """
    seen: set[int] = set()
    again = np.zeros(len(digests), bool)
    for k, digest in enumerate(digests):
        again[k] = digest in repeats or digest in seen
        seen.add(digest)
    first, last = (np.arange(len(digests)),) * 2 if spans is None else (spans[:, 0], spans[:, 1])
    depth = np.bincount(first[again], minlength=len(ends) + 1) - np.bincount(last[again] + 1, minlength=len(ends) + 1)
    covered = np.concatenate([[0], np.cumsum(depth) > 0]).astype("int8")
    edges = np.flatnonzero(np.diff(covered))
    starts = np.concatenate([[0], ends])
    found = zip(starts[edges[::2]].tolist(), starts[edges[1::2]].tolist())
    return [(a, b) for a, b in found if b - a >= min_bytes]


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_bytes: int = MIN_BYTES,
    removed: str | None = "removed",
) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; all its columns are kept.

    A document is a key and a text: rows equal in both count as one document and are treated
    alike. Of the documents that hold a run of chunks the one of smallest rank, a hash of key
    and text, keeps it; so one copy of a passage stays. Every byte that is cut lies in a run of at
    least ``min_bytes`` that occurs as a whole elsewhere. ``removed`` (None: left out) holds the byte spans that were cut,
    replacing a column of that name. A null text stays null; an empty table gives an empty
    result.

    Only (digest, rank) pairs are shuffled to find repeats, pre-aggregated for each digest, so
    a passage that a third of all documents share costs a row per task. The texts are moved
    once, to meet their list of repeats.
    """
    rank = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text))
    narrow = docs.where(F.col(text).isNotNull()).select(rank.alias("rank"), F.col(text).alias("text"))

    def pairs(batches):
        import pyarrow as pa

        forget_words()
        try:
            for batch in batches:
                ranks = batch.column(0).to_pylist()
                for start in range(0, batch.num_rows, 128):
                    own = [list(set(runs(t, min_bytes)[3])) for t in batch.column(1).slice(start, 128).to_pylist()]
                    found = np.fromiter((d for ds in own for d in ds), "int64")
                    whose = np.repeat(np.array(ranks[start : start + 128], "int64"), [len(ds) for ds in own])
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(whose)], names=["digest", "rank"])
        finally:
            release()

    held = narrow.mapInArrow(pairs, "digest long, rank long")
    shared = held.groupBy("digest").agg(F.min("rank").alias("_first"), F.max("rank").alias("_last"))
    shared = staged(shared.where("_first < _last").select("digest", "_first"), "shared")
    repeats = held.join(shared, "digest").where(F.col("rank") > F.col("_first"))
    lists = repeats.groupBy("rank").agg(F.collect_set("digest").alias("_repeats")).withColumnRenamed("rank", "_whose")

    names = [c for c in docs.columns if c != removed]
    met = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"), F.when(F.col(text).isNotNull(), rank).alias("_rank"))
    met = met.join(lists, met["_rank"] == lists["_whose"], "left")
    schema = met.select("_row", F.lit(None).cast("string").alias("_text"), F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))).alias("_spans")).schema
    types = to_arrow_schema(schema)

    def cut(batches):
        import pyarrow as pa

        def one(whole: str | None, own: list | None) -> tuple[str | None, list]:
            raw, ends, chunks_of, digests = runs(whole, min_bytes)
            spans = removed_spans(ends, digests, set() if own is None else set(own), min_bytes, chunks_of)
            if spans:
                rest = [raw[a:b] for a, b in zip([0, *[b for _, b in spans]], [*[a for a, _ in spans], len(raw)])]
                whole = b"".join(rest).decode("utf-8", "replace")
            return whole, [{"start": a, "end": b} for a, b in spans]

        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 128):
                    part = batch.slice(start, 128)
                    texts = part.column("_row").field(part.column("_row").type.get_field_index(text))
                    done = [one(t, own) for t, own in zip(texts.to_pylist(), part.column("_repeats").to_pylist())]
                    columns = [part.column("_row"), pa.array([t for t, _ in done], pa.string()), pa.array([x for _, x in done], types.field("_spans").type)]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, types)], schema=types)
        finally:
            release()

    done = met.select("_row", "_repeats").mapInArrow(cut, schema)
    out = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in names]
    return done.select(*out, *([F.col("_spans").alias(removed)] if removed else []))
