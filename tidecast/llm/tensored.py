"""MinHash near-duplicates by tensored banding, confirmed on whole shingle sets.

Two collections of ``COLLECTION`` hashes each are drawn; a hash is the least values of ``HALF``
MinHash functions. Every pair of one hash of either collection is the key of a table, so 2 * 16 * 3
functions make 16 * 16 tables of six values each, where tables drawn one by one would need
sixteen times as many. Two texts share a table exactly if they agree in at least one hash of
each collection; at a similarity of 0.85 they fail to once in two million times, and less often
above.

Texts of equal sets are one node. A hash that one node alone has can not be half of a shared
key, so such hashes are dropped before the keys are formed. Candidates never are all pairs of a
table. Nodes that tables connect form a cluster, and every node is compared with one of it, its
pivot, which joins most near copies. The others are told by their differences from the pivot, the
shingles that only one of node and pivot has. The symmetric difference of two nodes is that of their
differences, so two linked nodes must have most of theirs in common; they are compared only if
they share one of the rarest, as many as a link of their sizes can not do without. That search is
exact, and what all copies of a text share is in no difference, so near copies that just miss
the threshold and unlike texts with one template cost a row for each and hardly any pairs. Shingles that
the same nodes have beyond the pivot count as one, and all that meet there are compared with the
least and the greatest of them first, so copies of one another that are far from the pivot make no pairs either.

Nodes far from their pivot are clustered anew without the near ones. The Jaccard distance is a
metric: of two linked nodes either both are within ``NEAR`` and a link's length of the pivot, or
both are beyond ``NEAR``, so no pair is lost between the rounds. The last round takes all that is left.

Two nodes whose differences have nothing in common are linked only if both are linked to the pivot:
let c be (1 - t) / (1 + t) for the threshold t. A link means that the symmetric difference d is at
most c (|a| + |b|). Here d = |A| + |B| for the differences A and B, and |b| <= |p| + |B|, so
|A| <= c (|a| + |p|) + (c - 1) |B|, which links a and p; likewise b and p.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.llm.common import components, map_rows, staged
from tidecast.llm.minhash import shingles

WORDS = 5
LEAST = 85
HALF = 3
COLLECTION = 16
_FUNCTIONS = 2 * COLLECTION * HALF
_FACTORS = np.random.default_rng(12).integers(0, 1 << 63, (_FUNCTIONS, 1), "uint64") << np.uint64(1) | np.uint64(1)
_MIX = np.random.default_rng(13).integers(0, 1 << 63, HALF, "uint64") << np.uint64(1) | np.uint64(1)
_BLOCK = 4096
#: The distance from a pivot up to which nodes are done with it, and how many pivots a node may meet.
NEAR, ROUNDS = 0.5, 3
#: Sizes of differences are told apart in steps of this share of the pivot's size.
_STEP = 0.03


def digest(own: np.ndarray) -> bytes | None:
    """128 bits that stand for a whole shingle set; None for the empty one."""
    import xxhash

    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def hashes(own: np.ndarray) -> np.ndarray:
    """The hashes of a nonempty shingle set, one row for each of the two collections, as signed 64-bit integers."""
    least = np.full(_FUNCTIONS, np.iinfo("uint64").max)
    for at in range(0, len(own), _BLOCK):
        least = np.minimum(least, (own[at : at + _BLOCK] * _FACTORS).min(axis=1))
    least ^= least >> np.uint64(29)
    return (least.reshape(2, COLLECTION, HALF) * _MIX).sum(axis=2, dtype="uint64").view("int64")


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row (a number of its own), key, digest, size and both collections of hashes of every row, staged."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batch):
        for row, doc, whole in zip(batch["row"], batch["_key"], batch["_text"]):
            own = shingles(whole, WORDS)
            first, second = hashes(own).tolist() if len(own) else ([], [])
            yield row, doc, digest(own), len(own), first, second

    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    return staged(map_rows(narrow, f"row long, key {kind}, fp binary, size long, first array<long>, second array<long>", rows, 512), "sketches")


def nodes_of(found: DataFrame) -> DataFrame:
    """One row for each distinct nonempty set: node (the least row number that has it), its least key, and the row's sketch, staged."""
    each = found.where("size > 0").groupBy("fp").agg(F.min("row").alias("row"), F.min("key").alias("least_key"))
    whole = found.select("row", "key", "size", "first", "second").join(each, "row")
    return staged(whole.withColumnRenamed("row", "node"), "nodes")


def tables(nodes: DataFrame) -> DataFrame:
    """(met, node) of every table key ``met`` that several nodes have, staged."""

    def side(name: str) -> DataFrame:
        own = nodes.select("node", F.posexplode(name).alias("at", "hash"))
        several = own.groupBy("at", "hash").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low < _high")
        return own.join(several.select("at", "hash"), ["at", "hash"])

    left, right = side("first"), side("second").toDF("at_2", "hash_2", "node")
    keyed = left.join(right, "node").select(F.xxhash64("at", "hash", "at_2", "hash_2").alias("met"), "node")
    keyed = staged(keyed, "keys")
    return _several(keyed)


def _several(keyed: DataFrame) -> DataFrame:
    """The rows of keys that several nodes have, staged."""
    shared = keyed.groupBy("met").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low < _high")
    return staged(keyed.join(shared.select("met"), "met"), "tables")


def _clusters(keyed: DataFrame) -> DataFrame:
    """(node, pivot): the nodes that keys connect, each with the least of them, staged.

    A key stands for the least node that has it, and a node for the least of its keys'. What a node's
    keys stand for is connected; the node that a key stands for is among them by its own rows.
    """
    low = keyed.groupBy("met").agg(F.min("node").alias("low"))
    labels = keyed.join(low, "met").groupBy("node").agg(F.min("low").alias("label"), F.collect_set("low").alias("lows"))
    labels = staged(labels, "labels")
    edges = labels.select(F.explode("lows").alias("a"), F.col("label").alias("b")).where("a <> b")
    roots = components(edges.distinct()).toDF("label", "root")
    joined = labels.select("node", "label").join(roots, "label", "left").select("node", F.coalesce("root", "label").alias("pivot"))
    return staged(joined, "clusters")


def _measured(spokes: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(pivot, node, linked, distance) of every node and its pivot, staged."""

    def rows(batch):
        for pivot, node, first, second in zip(*(batch[c] for c in ("pivot", "node", "_first", "_second"))):
            both = len(np.intersect1d(np.frombuffer(first, "uint64"), np.frombuffer(second, "uint64"), assume_unique=True))
            whole = len(first) // 8 + len(second) // 8 - both
            yield pivot, node, 100 * both >= least * whole, 1 - both / whole

    met = spokes.join(sets.toDF("pivot", "_first"), "pivot").join(sets.toDF("node", "_second"), "node")
    return staged(map_rows(met, "pivot long, node long, linked boolean, distance double", rows), "measured")


def _confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar enough, staged."""
    found = _measured(pairs.toDF("pivot", "node"), sets, least).where("linked")
    return found.select(F.col("pivot").alias("a"), F.col("node").alias("b"))


def _differences(spokes: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, node, width, tokens): the shingles that only one of node and pivot has, and the step of sizes, staged."""

    def rows(batch):
        for pivot, node, first, second in zip(*(batch[c] for c in ("pivot", "node", "_first", "_second"))):
            first, second = np.frombuffer(first, "uint64"), np.frombuffer(second, "uint64")
            width = max(1, int(_STEP * len(first)))
            yield pivot, node, width, np.setxor1d(first, second, assume_unique=True).view("int64").tolist()

    met = spokes.join(sets.toDF("pivot", "_first"), "pivot").join(sets.toDF("node", "_second"), "node")
    return staged(map_rows(met, "pivot long, node long, width int, tokens array<long>", rows, 64), "differences")


def _may_link(a: Column, b: Column, least: int) -> Column:
    return F.lit(100) * F.least(a, b) >= F.lit(least) * F.greatest(a, b)


def _rarest(differences: DataFrame, known: DataFrame, least: int) -> DataFrame:
    """(pivot, low, high, met, step, node, size): what of its difference from a pivot a node needs for a link, staged.

    A link of a to a node with a difference of at least ``low`` tokens shares at least half of
    ``|A| + low - most`` of them, ``most`` being the largest symmetric difference that a
    link of a text of its size allows. So the rarest ``|A| - shared + 1`` tokens of either
    meet, in an order that all differences from a pivot have in common. Partners are told apart by the step
    of their size, which says how many tokens that are. Tokens that the same nodes have are one: nodes
    that share many of them meet once (``met``, a hash of the nodes; if two were equal, more nodes would meet).
    """
    each = staged(differences.select("pivot", "node", "width", F.explode("tokens").alias("token")), "tokens")
    often = each.groupBy("pivot", "token").agg(F.count(F.lit(1)).alias("often"), F.bit_xor(F.xxhash64("node")).alias("met"))
    own = each.join(often, ["pivot", "token"]).groupBy("pivot", "node", "width")
    own = own.agg(F.sort_array(F.collect_list(F.struct("often", "met", "token"))).alias("own")).join(known.select("node", "size"), "node")
    n, most = F.size("own"), F.col("size") * F.lit((100 - least) / least) + F.lit(1e-6)
    steps = F.sequence(F.greatest(F.lit(0), F.floor((n - most) / F.col("width"))).cast("int"), F.floor((n + most) / F.col("width")).cast("int"))
    own = own.select("pivot", "node", "size", "own", most.alias("most"), F.floor(n / F.col("width")).cast("int").alias("step"), "width", F.explode(steps).alias("other"))
    shared = F.greatest(F.lit(1), F.ceil((n + F.col("other") * F.col("width") - F.col("most")) / 2).cast("int"))
    needed = F.slice("own", F.lit(1), F.greatest(F.lit(0), n - shared + 1))
    # A token of one difference alone meets no other.
    met = F.array_distinct(F.transform(F.filter(needed, lambda t: t["often"] > 1), lambda t: t["met"]))
    low, high = F.least("step", "other").alias("low"), F.greatest("step", "other").alias("high")
    return staged(own.select("pivot", low, high, F.explode(met).alias("met"), "step", "node", "size"), "rarest")


def _stars(rare: DataFrame, known: DataFrame, least: int, one: Callable[[Column], Column]) -> DataFrame:
    """Pairs (a, b) of nodes of different groups: those that meet, each with ``one`` of them (the least or greatest)."""
    where = ["pivot", "low", "high", "met"]
    each = rare.join(known.select("node", "root"), "node")
    low = each.groupBy(*where).agg(one(F.struct("node", "size", "root")).alias("_to"), F.max("root").alias("_most"), F.min("root").alias("_least")).where("_least < _most")
    met = each.join(low.select(*where, "_to"), where).where("root <> _to.root")
    return met.where(_may_link(F.col("size"), F.col("_to.size"), least)).select(F.col("_to.node").alias("a"), F.col("node").alias("b")).distinct()


def _rest(rare: DataFrame, known: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of all nodes of different groups that meet."""
    each = rare.join(known.select("node", "root"), "node")
    left = each.where("step = low").select("pivot", "low", "high", "met", F.col("node").alias("a"), F.col("root").alias("_root"), F.col("size").alias("_size"))
    right = each.where("step = high").select("pivot", "low", "high", "met", F.col("node").alias("b"), "root", "size")
    once = (F.col("low") < F.col("high")) | (F.col("a") < F.col("b"))
    met = left.join(right, ["pivot", "low", "high", "met"]).where(once & (F.col("_root") != F.col("root")))
    return met.where(_may_link(F.col("_size"), F.col("size"), least)).select("a", "b").distinct()


def _known(sizes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, size, root): every node with the least one that links reach, staged."""
    roots = components(links).toDF("node", "_root")
    known = sizes.join(roots, "node", "left")
    return staged(known.select("node", "size", F.coalesce("_root", "node").alias("root")), "known")


def connected(
    met: DataFrame, again: Callable[[DataFrame], DataFrame], sizes: DataFrame, sets: DataFrame, least: int
) -> DataFrame:
    """Pairs (a, b) that connect all linked nodes of which some key ``met`` is common.

    ``met`` holds (met, node), ``again`` gives keys for the far nodes alone, ``sizes`` (node, size) and
    ``sets`` (node, own) the shingles of every node in ``met``.
    """
    spokes = []
    for k in range(ROUNDS):
        clusters = _clusters(met)
        measured = _measured(clusters.where("node <> pivot").select("pivot", "node"), sets, least)
        last = k + 1 == ROUNDS
        spokes.append(measured if last else measured.where(F.col("distance") <= NEAR + 1 - least / 100 + 1e-9))
        if last:
            break
        far = staged(measured.where(F.col("distance") > NEAR).select("node"), "far")
        if far.isEmpty():
            break
        met = _several(again(far))
    near = spokes[0]
    for part in spokes[1:]:
        near = near.unionByName(part)
    near = staged(near.select("pivot", "node", "linked"), "near")
    first = near.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    known = _known(sizes, first)

    # The nodes of one pivot, of which at least two are in different groups and not all are the pivot's.
    rooted = near.join(known.select("node", "root"), "node")
    apart = rooted.groupBy("pivot").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high")
    open_spokes = near.join(apart.select("pivot"), "pivot", "left_semi").select("pivot", "node")
    rare = _rarest(_differences(open_spokes, sets), known, least)
    for one in (F.min, F.max):
        first = first.unionByName(_confirmed(_stars(rare, known, least, one), sets, least))
        known = _known(sizes, first)
    return first.unionByName(_confirmed(_rest(rare, known, least), sets, least))


def links(docs: DataFrame, nodes: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Pairs (a, b) of nodes that connect all nodes whose sets are linked."""
    met = tables(nodes)
    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi").select(F.col("key").alias("_wanted")).distinct()
    narrow = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    chosen = narrow.join(wanted, F.col("_key").eqNullSafe(F.col("_wanted")), "left_semi").select("_text")

    def rows(batch):
        for whole in batch["_text"]:
            own = shingles(whole, WORDS)
            if len(own):
                yield digest(own), own.tobytes()

    sets = map_rows(chosen, "fp binary, own binary", rows, 64).dropDuplicates(["fp"])
    sets = staged(sets.join(nodes.select("fp", "node"), "fp").select("node", "own"), "sets")

    def again(far: DataFrame) -> DataFrame:
        # The first collection alone connects all that a table would, with a row for each hash and not each key.
        own = nodes.join(far, "node", "left_semi").select("node", F.posexplode("first").alias("at", "hash"))
        return own.select(F.xxhash64("at", "hash").alias("met"), "node")

    return connected(met, again, nodes.select("node", "size"), sets, least)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """Every row with key, n_shingles, component_id (the smallest key that links reach) and kept (key is component_id).

    A text's set holds its distinct shingles of five words, A-Z in lower case; fewer words form
    one shingle. Sets link if 100 times the shingles they share are at least ``least`` times
    those that either has. A text without a word, or a null one, has the empty set and is linked with
    nothing. Repeated rows are returned each. A null key is a component's id only if it has
    no other. An empty table gives an empty result; other columns are ignored.
    """
    found = sketches(docs, key, text)
    nodes = nodes_of(found)
    roots = components(links(docs, nodes, key, text, least)).toDF("node", "root")
    rooted = nodes.select("fp", "node", "least_key").join(roots, "node", "left")
    rooted = staged(rooted.select("fp", "least_key", F.coalesce("root", "node").alias("root")), "classes")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least_key").alias("component_id")), "root")
    whole = found.where("size > 0").select("key", "fp", "size").join(named.select("fp", "component_id"), "fp")
    empty = found.where("size = 0").select("key", "size", F.col("key").alias("component_id"))
    rows = whole.select("key", "size", "component_id").unionByName(empty)
    kept = F.col("key").eqNullSafe(F.col("component_id"))
    return rows.select(F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id", kept.alias("kept"))
