"""Hard negatives of embeddings: one-bit codes and deterministic intervals first, integer scores for what is left.

Vectors are scaled to whole numbers and rotated by one fixed random rotation. A code is the sign
of each rotated coordinate; with it the *alignment* is stored, the inner product of the
vector with its code as a unit vector. What alignment times code leaves over is coded the same
way, ``LEVELS`` times, and the length of the last residual is stored too. For two vectors,
popcounts of the exclusive-or of their codes, weighted by the alignments, give the inner
product of what is coded; by Cauchy-Schwarz the true one differs by at most
``|q| * residual(x) + residual(q) * |coded x|``. The interval is certain, not likely, so a
row is dropped only if it can not be in the result. Intervals that survive are scored with the
whole numbers themselves.

Anchors are a stated query set against all rows. Rows are dealt into groups of about
``GROUP`` by a hash of their id, whatever their label; each anchor is sent to every group, and a
task holds one group and meets the anchors in pieces as they stream by. Each group returns the few best rows
of an anchor, which are ranked again over all groups.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.llm.common import arrow_types, record_batches, staged

LEVELS = 4
GROUP = 4096
_PIECE = 256
_FIELDS = "id long, label long, v array<{kind}>, codes binary, scales array<double>, positives array<long>"


def rotation(size: int, seed: int = 42) -> np.ndarray:
    """A fixed random rotation of ``size`` dimensions."""
    turned, upper = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))
    return turned * np.sign(np.diag(upper))


def encode(vectors: np.ndarray, turn: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, levels, words) as unsigned 64-bit integers, and scales (rows, levels + 3).

    The scales are the alignment of each level, the length of the vector, that of the last
    residual and that of what is coded.
    """
    size = len(turn)
    rest = np.zeros((len(vectors), size))
    rest[:, : vectors.shape[1]] = vectors
    rest = whole = rest @ turn
    codes, scales = [], []
    for _ in range(levels):
        sign = rest > 0
        unit = np.where(sign, 1.0, -1.0) / np.sqrt(size)
        along = (rest * unit).sum(axis=1)
        rest = rest - along[:, None] * unit
        codes.append(np.packbits(sign, axis=1, bitorder="little").view("<u8"))
        scales.append(along)
    lengths = [np.linalg.norm(x, axis=1) for x in (whole, rest, whole - rest)]
    return np.stack(codes, axis=1), np.stack([*scales, *lengths], axis=1)


def intervals(q_codes, q_scales, codes, scales) -> tuple[np.ndarray, np.ndarray]:
    """Certain lower and upper bounds of the inner products of all queries (first axis) and rows."""
    levels, words = codes.shape[1:]
    mid = np.zeros((len(q_codes), len(codes)), "float32")
    for i in range(levels):
        for j in range(levels):
            apart = sum(np.bitwise_count(q_codes[:, i, None, w] ^ codes[None, :, j, w]).astype("float32") for w in range(words))
            mid += (1 - apart / np.float32(32 * words)) * (q_scales[:, i, None] * scales[None, :, j]).astype("float32")
    half = q_scales[:, levels, None] * scales[None, :, levels + 1] + q_scales[:, levels + 1, None] * scales[None, :, levels + 2]
    # Rounding of the sums in single precision, with room to spare.
    half += 1e-5 * q_scales[:, :levels].sum(axis=1)[:, None] * scales[:, :levels].sum(axis=1)[None, :] + 1e-3
    return mid - half, mid + half


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


class _Group:
    """Some rows or anchors of a task as arrays, in order of id."""

    def __init__(self, batches: list, size: int, words: int, levels: int, exact: str):
        import pyarrow as pa

        table = pa.Table.from_batches(batches).combine_chunks()
        column = {n: table.column(n).combine_chunks() for n in ("id", "label", "v", "codes", "scales", "positives")}
        n = table.num_rows
        order = np.argsort(column["id"].to_numpy(), kind="stable")
        self.ids, self.labels = column["id"].to_numpy()[order], column["label"].to_numpy()[order]
        self.vectors = column["v"].flatten().to_numpy().reshape(n, size).astype(exact)[order]
        self.codes = np.frombuffer(b"".join(column["codes"].to_pylist()), "<u8").reshape(n, levels, words)[order]
        self.scales = column["scales"].flatten().to_numpy().reshape(n, levels + 3)[order]
        found = column["positives"].to_pylist()
        self.positives = [found[k] or [] for k in order.tolist()]

    def __len__(self) -> int:
        return len(self.ids)


def _positives(anchors: _Group, rows: _Group, n: int):
    """(anchor, row, score) of the ``n`` best other rows of an anchor's label within a group."""
    low, high = intervals(anchors.codes, anchors.scales, rows.codes, rows.scales)
    own = (anchors.labels[:, None] == rows.labels[None, :]) & (anchors.ids[:, None] != rows.ids[None, :])
    need = _kth_largest(np.where(own, low, -np.inf), n)
    for k in range(len(anchors)):
        left = np.flatnonzero(own[k] & (high[k] >= need[k]))
        scores = rows.vectors[left] @ anchors.vectors[k]
        for at in np.argsort(-scores, kind="stable")[:n].tolist():
            yield int(anchors.ids[k]), int(rows.ids[left[at]]), int(scores[at])


def _negatives(anchors: _Group, rows: _Group, n: int, least: int, most: int):
    """(anchor, place of the positive, row, score) of the ``n`` best rows of other labels within a positive's margin."""
    low, high = intervals(anchors.codes, anchors.scales, rows.codes, rows.scales)
    other = anchors.labels[:, None] != rows.labels[None, :]
    for k in range(len(anchors)):
        margins = [(least * p / 100, most * p / 100) for p in anchors.positives[k]]
        wanted = np.zeros(len(rows), bool)
        for bottom, top in margins:
            may = other[k] & (high[k] >= bottom) & (low[k] <= top)
            sure = low[k][may & (low[k] >= bottom) & (high[k] <= top)]
            if len(sure) >= n:
                may &= high[k] >= np.partition(sure, -n)[-n]
            wanted |= may
        left = np.flatnonzero(wanted)
        scores = (rows.vectors[left] @ anchors.vectors[k]).astype("int64")
        order = np.argsort(-scores, kind="stable")
        left, scores = left[order], scores[order]
        for place, positive in enumerate(anchors.positives[k]):
            fit = np.flatnonzero((least * positive <= 100 * scores) & (100 * scores <= most * positive))
            for at in fit[:n].tolist():
                yield int(anchors.ids[k]), place, int(rows.ids[left[at]]), int(scores[at])


def _meet(rows: DataFrame, anchors: DataFrame, groups: int, setting: tuple, visit, schema: str) -> DataFrame:
    """``visit(anchors, rows)`` for every group of ``rows`` and every piece of the anchors."""
    types = arrow_types(schema)
    narrow = ["id", "label", "v", "codes", "scales", "positives"]
    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("kind"), *narrow)
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(1).alias("kind"), *narrow)
    both = dealt.unionByName(sent).repartition(groups, "group").sortWithinPartitions("group", "kind", "id")

    def run(batches):
        def every():
            now, held, group = None, [], None
            for batch in batches:
                places = batch.column("group").to_numpy() * 2 + batch.column("kind").to_numpy()
                turns = np.flatnonzero(np.diff(places, prepend=-1))
                for start, stop in zip(turns.tolist(), [*turns[1:].tolist(), len(places)]):
                    place = int(places[start])
                    if place // 2 != group:
                        group, held, now = place // 2, [], None
                    if place % 2 == 0:
                        held.append(batch.slice(start, stop - start))
                        continue
                    if not held and now is None:
                        continue
                    now = now or _Group(held, *setting)
                    held = []
                    for at in range(start, stop, _PIECE):
                        yield from visit(_Group([batch.slice(at, min(_PIECE, stop - at))], *setting), now)

        yield from record_batches(types, every())

    return both.mapInArrow(run, schema)


def _usable(vectors: DataFrame, scale: int, key: str, vector: str, label: str) -> DataFrame:
    """id, label and whole-number vector of the rows that take part, one row for each id."""
    part = F.col(label).isNotNull() & F.col(key).isNotNull() & F.col(vector).isNotNull()
    real = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = vectors.where(part & real).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), whole.alias("v")
    )
    again = staged(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "repeated")
    first = rows.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v")).alias("_row"))
    return rows.join(again, "id", "left_anti").unionByName(first.select("id", "_row.label", "_row.v"))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    levels: int = LEVELS,
    group: int = GROUP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(``scale`` * x); a score is the inner product of these whole
    numbers, ties go to the smaller key. Anchors are the rows where ``is_anchor`` (of the
    column ``id``, the key) holds. Their positives are the ``n_positives`` best other rows of
    their label (all, if fewer). For each, the ``n_negatives`` best rows of other labels are
    returned whose score is from ``least`` to ``most`` percent of the positive's.

    Rows with a null key, label, vector or component, or a component that is not finite, take no
    part. Of rows that share a key the least (label, vector) counts. A shorter vector
    counts as filled up with zeros. Scores beyond 64 bits raise. An empty table, and anchors
    without a positive or a fitting negative, give no rows; other columns are ignored.
    """
    rows = staged(_usable(vectors, scale, key, vector, label), "vectors")
    wide = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("v")).alias("size"),
        F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("top"),
    ).first()
    size, top, groups = max(1, wide["size"] or 0), wide["top"] or 0, max(1, -(-wide["n"] // group))
    if size * top * top >= 1 << 63 or top < 0:
        raise ValueError("scores do not fit 64 bits")
    kind = "int" if top < 1 << 31 else "long"
    exact = "float64" if size * top * top < 1 << 53 else "int64"
    words = -(-size // 64)
    setting, turn = (size, words, levels, exact), rotation(64 * words)
    schema = _FIELDS.format(kind=kind)
    types = arrow_types(schema)

    def coded(batches):
        import pyarrow as pa

        for batch in batches:
            whole = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, size)
            codes, scales = encode(whole, turn, levels)
            flat = pa.array(scales.ravel())
            ends = pa.array(np.arange(batch.num_rows + 1, dtype="int32") * (levels + 3))
            own = [c.tobytes() for c in codes]
            none = pa.nulls(batch.num_rows, types.field("positives").type)
            columns = [batch.column("id"), batch.column("label"), batch.column("v"), pa.array(own, pa.binary()), pa.ListArray.from_arrays(ends, flat), none]
            yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, types)], schema=types)

    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))).cast(f"array<{kind}>")
    coded_rows = staged(rows.select("id", "label", filled.alias("v")).mapInArrow(coded, schema), "codes")
    anchors = coded_rows.where(is_anchor)

    met = _meet(coded_rows, anchors, groups, setting, lambda a, r: _positives(a, r, n_positives), "anchor_id long, id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    ranked = met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_positives)
    positives = staged(ranked, "positives")

    in_order = F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda p: p["score"])
    found = positives.groupBy(F.col("anchor_id").alias("id")).agg(in_order.alias("positives"))
    asking = anchors.drop("positives").join(found, "id").select(anchors.columns)
    met = _meet(
        coded_rows, asking, groups, setting, lambda a, r: _negatives(a, r, n_negatives, least, most),
        "anchor_id long, place int, negative_id long, negative_score long",
    )
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    whose = positives.select("anchor_id", F.col("place") - 1, F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(whose.toDF("anchor_id", "place", "positive_id", "positive_score"), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
