"""SimHash near-duplicates, found by covering locality-sensitive hashing.

For radius r every bit position gets a nonzero vector of r + 1 bits, and each nonzero vector v
makes a mask of the positions whose vector has an odd product with v. Any r positions span at
most r dimensions, so some v is orthogonal to all of them: two fingerprints that differ in
those positions agree under that mask. Hence every pair within the radius shares a bucket in
one of the 2^(r+1) - 1 tables, for certain.

Within shared buckets no pairs are formed: a fingerprint names itself and its neighbours at
one differing bit, over the bits that its shared buckets leave free. Two fingerprints name a
common one exactly if they differ in at most two bits, and at most 65 can name the same one.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ascii_lower, components, map_rows, staged

RADIUS = 2
_BITS_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype("int64")


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The masks of all tables, as signed 64-bit integers."""
    top = 1 << (radius + 1)
    found = []
    for v in range(1, top):
        mask = sum(1 << i for i in range(bits) if ((i % (top - 1) + 1) & v).bit_count() % 2)
        found.append(mask - (1 << 64) if mask >> 63 else mask)
    return found


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a whole text over its word shingles, repeats included, as a signed integer.

    Fewer words than a shingle has form one; no word (or a null text) gives zero.
    """
    import xxhash

    own = ascii_lower(text or "").split()
    if not own:
        return 0
    joined = b" ".join(own)
    if len(own) <= words:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        lengths = np.fromiter(map(len, own), "int64", len(own))
        ends = np.cumsum(lengths + 1) - 1
        digest = xxhash.xxh64_intdigest
        spans = zip((ends - lengths)[: 1 - words].tolist(), ends[words - 1 :].tolist())
        hashes = [digest(joined[a:b], seed) for a, b in spans]
    return majority(np.array(hashes, "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of some 64-bit hashes have, as a signed integer."""
    lanes = hashes.view("u1").reshape(-1, 8)
    if len(hashes) < 256:
        set_bits = np.unpackbits(lanes, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    else:
        set_bits = np.concatenate([np.bincount(lanes[:, k], minlength=256) @ _BITS_OF_BYTE for k in range(8)])
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ``fp`` of every row, staged."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batch):
        for doc, whole in zip(batch["_key"], batch["_text"]):
            yield doc, fingerprint(whole)

    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return staged(map_rows(narrow, f"`{key}` {kind}, fp long", rows), "fingerprints")


def neighbours(distinct: DataFrame) -> DataFrame:
    """(named, fps): groups of distinct fingerprints ``fp``; two are in a common group exactly if they are within the radius."""
    if RADIUS != 2:
        raise ValueError("links are made for two differing bits")
    tables = masks()
    entries = distinct.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("bucket")) for v, m in enumerate(tables)])
        ).alias("t"),
    ).select("fp", "t.v", "t.bucket")
    shared = entries.groupBy("v", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    free = F.element_at(F.array(*[F.lit(~m) for m in tables]), F.col("v") + 1)
    members = entries.join(shared, ["v", "bucket"]).groupBy("fp").agg(F.bit_or(free).alias("free"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    named = members.select(
        "fp",
        F.explode(F.filter(flips, lambda f: f.bitwiseAND(F.col("free")) == f)).alias("flip"),
    ).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("named"))
    return named.groupBy("named").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` within the radius, without listing all pairs."""
    groups = neighbours(distinct)
    return groups.select(F.array_min("fps").alias("b"), F.explode("fps").alias("a")).where("a <> b").distinct().select("a", "b")


def classes(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per distinct fingerprint: fp, ``root`` (the smallest fingerprint linked to it) and component_id, staged."""
    nodes = staged(prints.groupBy("fp").agg(F.min(key).alias("_first")), "nodes")
    roots = components(links(nodes.select("fp")))
    labelled = nodes.join(roots, nodes["fp"] == roots["a"], "left").select(
        "fp", "_first", F.coalesce("b", "fp").alias("root")
    )
    least = labelled.groupBy("root").agg(F.min("_first").alias("component_id"))
    return staged(labelled.join(least, "root").select("fp", "root", "component_id"), "classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with key, fingerprint (16 hex digits) and component_id, the smallest key reachable by links.

    Fingerprints link at two or fewer differing bits. Null and empty texts have fingerprint
    zero, which links like any other; a null key never becomes a component's id unless all
    its keys are null. Repeated rows are returned each. An empty table gives an empty result;
    other columns are ignored.
    """
    prints = fingerprints(docs, key, text)
    found = prints.join(classes(prints, key), "fp")
    return found.select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each component: that of the smallest key (nulls last).

    Keys may repeat or be null: such rows are told apart by their fingerprints, and equal
    rows count as one. All columns are kept as they are.
    """
    prints = fingerprints(docs, key, text)
    own = prints.join(classes(prints, key), "fp").select(key, "fp", "root")
    return one_of_each(docs, own, fingerprint, key, text)


def one_of_each(docs: DataFrame, own: DataFrame, fingerprint: Callable[[str | None], int], key: str, text: str) -> DataFrame:
    """The row of smallest key of each root, given key, fp and root of every row; ``fingerprint`` makes fp of a text."""
    ids = own.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    order = F.struct(F.col(key).isNull().alias("_null"), F.col(key), F.col("fp"))
    kept = own.distinct().groupBy("root").agg(F.min(order).alias("_keep")).select(f"_keep.{key}", "_keep.fp")
    kept = staged(kept, "kept")
    several = ids.where((F.col("_n") > 1) | F.col(key).isNull()).select(key)
    gone = staged(ids.select(key).join(kept.select(key), key, "left_anti").unionByName(several).where(F.col(key).isNotNull()).distinct(), "gone")
    several = staged(several, "several")
    single = docs.where(F.col(key).isNotNull()).join(gone, key, "left_anti").select(docs.columns)

    @F.pandas_udf("long")
    def print_of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(whole) for whole in texts], dtype="int64")

    same = docs[key].eqNullSafe(several[key])
    again = docs.join(several, same, "left_semi").select(F.struct("*").alias("_row"), F.col(key).alias("_key"), print_of(F.col(text)).alias("_fp"))
    chosen = kept.select(F.col(key).alias("_kept"), F.col("fp").alias("_kept_fp"))
    again = again.join(chosen, F.col("_key").eqNullSafe(F.col("_kept")) & (F.col("_fp") == F.col("_kept_fp")), "left_semi")
    return single.unionByName(again.dropDuplicates(["_key", "_fp"]).select("_row.*"))
