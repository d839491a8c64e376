"""Near copies by the Jaccard similarity of their word shingles: SimHash and MinHash bands, then the exact similarity.

A text is the set of its shingles of five words. Each of ``BANDS`` bands hashes the least values of
``ROWS`` hash functions; two texts of similarity s agree in a band with probability s^ROWS, so a
pair at 0.8 shares no band once in 1.6 million times, and more similar ones less often. A text also has
the SimHash of its shingles; those that differ in at most two bits are all found
(``simhash.neighbours``), whatever the bands. Every pair that shares a band or is that near is compared by its whole shingle sets unless it is linked already or its
sizes rule it out; nothing is capped.

Texts of equal sets are one node. No pairs of a bucket are formed: nodes that buckets connect are compared
with one pivot, and what is left apart by its differences from it (``tensored.connected``).
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import ascii_lower, components, map_rows, staged
from tidecast.llm.simhash import majority, neighbours, one_of_each

WORDS = 5
#: Percent of the shingles of two texts that they share.
LEAST = 80
ROWS = 5
BANDS = 36
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, (BANDS * ROWS, 1), "uint64") << np.uint64(1) | np.uint64(1)
_MIX = np.random.default_rng(43).integers(0, 1 << 63, ROWS, "uint64") << np.uint64(1) | np.uint64(1)
_BLOCK = 4096


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct 64-bit hashes of a whole text's word shingles, sorted; fewer words than a shingle has form one."""
    import xxhash

    own = ascii_lower(text or "").split()
    if not own:
        return np.zeros(0, "uint64")
    joined, digest = b" ".join(own), xxhash.xxh3_64_intdigest
    if len(own) <= words:
        return np.array([digest(joined)], "uint64")
    lengths = np.fromiter(map(len, own), "int64", len(own))
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths)[: 1 - words].tolist(), ends[words - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in spans), "uint64"))


def print_of(own: np.ndarray) -> int:
    """A signed 64-bit digest of a shingle set; 0 for the empty one."""
    import xxhash

    value = xxhash.xxh3_64_intdigest(own.tobytes()) if len(own) else 0
    return value - (1 << 64) if value >> 63 else value


def bands(own: np.ndarray) -> list[int]:
    """The buckets of a shingle set, one for each band as signed 64-bit integers; none for the empty set."""
    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo("uint64").max)
    for at in range(0, len(own), _BLOCK):
        least = np.minimum(least, (own[at : at + _BLOCK] * _FACTORS).min(axis=1))
    least ^= least >> np.uint64(29)
    mixed = (least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype="uint64")
    return mixed.view("int64").tolist()


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ``fp`` (digest of the shingle set), its size, buckets and SimHash (null for the empty set) of every row, staged."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batch):
        for doc, whole in zip(batch["_key"], batch["_text"]):
            own = shingles(whole)
            yield doc, print_of(own), len(own), bands(own), majority(own) if len(own) else None

    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return staged(map_rows(narrow, f"`{key}` {kind}, fp long, size long, bands array<long>, sim long", rows, 512), "prints")


def classes(docs: DataFrame, prints: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Per distinct shingle set: fp and ``root``, the smallest fp that links of similar sets reach, staged."""
    from tidecast.llm import tensored  # which takes its shingles from here

    firsts = [F.first(c).alias(c) for c in ("size", "bands", "sim")]
    nodes = staged(prints.groupBy("fp").agg(F.min(key).alias("_first"), *firsts), "nodes")
    entries = nodes.select("fp", "size", F.posexplode("bands").alias("band", "bucket"))
    sims = nodes.where(F.col("sim").isNotNull()).select("fp", "size", "sim")
    near = neighbours(sims.select(F.col("sim").alias("fp")).distinct()).select(F.col("named").alias("bucket"), F.explode("fps").alias("sim"))
    near = near.unionByName(sims.select(F.col("sim").alias("bucket"), "sim")).distinct()
    entries = entries.unionByName(sims.join(near, "sim").select("fp", "size", F.lit(BANDS).alias("band"), "bucket"))
    of_bucket = entries.groupBy("band", "bucket").agg(F.min("fp").alias("_least"), F.max("fp").alias("_most"))
    shared = of_bucket.where("_least < _most").select("band", "bucket", "_least")
    entries = staged(entries.join(shared, ["band", "bucket"]), "entries")

    wanted = nodes.join(entries.select("fp").distinct(), "fp", "left_semi").select(F.col("_first").alias("_wanted")).distinct()
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    chosen = narrow.join(wanted, F.col("_key").eqNullSafe(F.col("_wanted")), "left_semi").select("_text")

    def rows(batch):
        for whole in batch["_text"]:
            own = shingles(whole)
            yield print_of(own), own.tobytes()

    sets = staged(map_rows(chosen, "fp long, own binary", rows, 64).dropDuplicates(["fp"]), "sets")
    keyed = entries.select(F.xxhash64("band", "bucket").alias("met"), F.col("fp").alias("node"))

    def again(far: DataFrame) -> DataFrame:
        return keyed.join(far, "node", "left_semi").select("met", "node")

    found = tensored.connected(keyed, again, nodes.select(F.col("fp").alias("node"), "size"), sets.withColumnRenamed("fp", "node"), least)
    roots = components(found)
    found = nodes.join(roots, nodes["fp"] == roots["a"], "left").select("fp", F.coalesce("b", "fp").alias("root"))
    return staged(found, "classes")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each group that links of similarity 0.8 connect: that of the smallest key (nulls last).

    Texts without a word form one group. Keys may repeat or be null: such rows are told apart
    by their shingle sets, and rows of equal key and set count as one. All columns are kept.
    """
    found = prints(docs, key, text)
    own = found.select(key, "fp").join(classes(docs, found, key, text), "fp").select(key, "fp", "root")
    return one_of_each(docs, own, lambda whole: print_of(shingles(whole)), key, text)
