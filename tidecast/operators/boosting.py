"""Regularised boosted trees of second order, many of them grown together.

Every (trial, fold) is a model of its own: parameters, a range of positions to train on and one
to predict. Rows are stored once, with each feature as a bin between quantiles and one margin
per model; a fold is a range of positions, never a copy of rows. All models grow level by
level in the same passes: tasks add up gradients and hessians per (model, node, feature, bin),
one aggregation sums them, and window sums over the bins give every split its gain. The number
of jobs follows the trees and levels alone, not trials or folds; only the chosen splits come to
the driver.

Passes over a small table are all overhead, and a search has thousands of trees. If the bins of all rows
fit into a task (``_WHOLE`` bytes), every task has them and grows one model at a time to its end, with the
same draws, sums and splits: the models are equal to the last bit.

Gradients and hessians are rounded to whole multiples of 2^-24 before they are added, so their
sums do not depend on the order of rows or tasks: a model grown among others equals one grown
alone, and a lost task repeated gives the same tree.

Leaf weight is ``-T(G) / (H + l2)`` and a split's gain ``S(left) + S(right) - S(node)``, where
``T`` shrinks the gradient sum towards zero by ``l1`` and ``S = T(G)^2 / (H + l2)``. A node is
split if the best gain exceeds ``min_gain``. Rows without a value go to the side that gains more.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Sequence
from copy import copy
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast.session import scratch_dir

SEED = 42
BINS = 32
_UNIT = 1 << 24
#: Trees that are kept beside the stored margins before these are written anew.
_KEPT_BACK = 10
#: Bytes of histograms that a task may hold.
_ROOM = 1 << 28
#: Bytes of a table, without what predictions keep, that a task may hold whole.
_WHOLE = 1 << 27


@dataclass(frozen=True)
class Params:
    """Settings of the boosted trees."""

    trees: int = 10
    depth: int = 3
    rate: float = 0.1
    row_share: float = 0.9
    column_share: float = 0.9
    min_gain: float = 0.0
    l1: float = 0.0
    l2: float = 1.0
    min_child: float = 1.0


@dataclass(frozen=True)
class Job:
    """One model: it learns from positions in ``train`` and predicts those in ``test`` (ends exclusive)."""

    params: Params
    train: tuple[int, int]
    test: tuple[int, int] = (0, 0)


@dataclass
class Tree:
    """Nodes in heap order from 1: feature (-1 at a leaf), bin, side of missing values, value and gain."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(np.full(n, -1, "int32"), np.zeros(n, "int32"), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        node, each = np.ones(len(bins), "int64"), np.arange(len(bins))
        for _ in range(len(self.feature).bit_length() - 2):
            feature = self.feature[node]
            if not (feature >= 0).any():
                break
            own = bins[each, np.maximum(feature, 0)]
            left = np.where(own == 0, self.missing_left[node], own <= self.bin[node])
            node = np.where(feature < 0, node, 2 * node + ~left)
        return node


@dataclass
class Boosted:
    """A grown model."""

    columns: list[str]
    cuts: list[np.ndarray]
    params: Params
    trees: list[Tree] = field(default_factory=list)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return sum((t.value[t.leaves(bins)] for t in self.trees), np.zeros(len(bins)))

    def importance(self) -> dict[str, float]:
        """Each feature's share of all gain."""
        own = np.zeros(len(self.columns))
        for tree in self.trees:
            split = tree.feature >= 0
            np.add.at(own, tree.feature[split], tree.gain[split])
        return dict(zip(self.columns, (own / own.sum() if own.sum() else own).tolist()))


def cuts_of(df: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """The bounds between bins: each feature's distinct quantiles over all rows with a value."""
    shares = [k / bins for k in range(1, bins)]

    def known(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.when(~F.isnan(value), value)

    found = df.agg(*[F.percentile_approx(known(c), shares, 10_000).alias(f"c{k}") for k, c in enumerate(columns)]).first()
    return [np.unique(np.array(row if row is not None else [], "float64")) for row in found]


def binned(batch, columns: list[str], cuts: list[np.ndarray]) -> np.ndarray:
    """Bins of an Arrow batch's features: 0 for a missing value, k + 1 above k bounds."""
    found = np.zeros((batch.num_rows, len(columns)), "uint8")
    for k, name in enumerate(columns):
        values = batch.column(name).cast("float64").to_numpy(zero_copy_only=False)
        found[:, k] = np.where(np.isnan(values), 0, np.searchsorted(cuts[k], values, "left") + 1)
    return found


def _draws(ids: np.ndarray, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row id and tree."""
    x = ids.view("uint64") + np.uint64((0x9E3779B97F4A7C15 * (tree + 1 + (SEED << 20))) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) / 2.0**64


def _features_of(params: Params, n: int, tree: int) -> np.ndarray:
    """The features that a tree may split on: the share of ``column_share``, one at least."""
    size = max(1, round(params.column_share * n))
    return np.sort(np.random.default_rng([SEED, tree]).permutation(n)[:size])


def _matrix(column, kind: str) -> np.ndarray:
    """A binary Arrow column of equally long values as one row each, without a copy."""
    import pyarrow as pa

    _, ends, raw = column.buffers()
    ends = np.frombuffer(ends, "int64" if pa.types.is_large_binary(column.type) else "int32")[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(raw, "uint8")[ends[0] : ends[-1]].view(kind).reshape(len(column), -1)


class _Growth:
    """All models of a wave: their trees, and those that the stored margins lack."""

    def __init__(self, jobs: Sequence[Job], n_features: int, n_bins: int):
        self.jobs, self.n_features, self.n_bins = jobs, n_features, n_bins
        self.late: list[list[Tree]] = [[] for _ in jobs]
        self.now: list[Tree | None] = [None] * len(jobs)
        self.open: list[list[int]] = [[] for _ in jobs]
        self.number = 0

    def margins(self, batch) -> np.ndarray:
        stored = _matrix(batch.column("margins"), "float64").copy()
        bins = self.bins(batch)
        for m in range(len(self.late)):
            stored[:, m] = self.late_added(m, stored[:, m], bins)
        return stored

    def late_added(self, m: int, margins: np.ndarray, bins: np.ndarray) -> np.ndarray:
        """The stored margins of some rows of a model with those of its late trees."""
        for tree in self.late[m]:
            margins = margins + tree.value[tree.leaves(bins)]
        return margins

    def bins(self, batch) -> np.ndarray:
        return _matrix(batch.column("bins"), "uint8")

    def histograms(self, batches):
        """(model, node, feature, bin, g, h) over a task's rows, for the open nodes of every model."""
        import pyarrow as pa

        width, sums = self.n_bins + 1, {}
        features = {m: _features_of(self.jobs[m].params, self.n_features, self.number) for m, own in enumerate(self.open) if own}
        for batch in batches:
            if not batch.num_rows:
                continue
            at, y = batch.column("at").to_numpy(), batch.column("y").to_numpy()
            bins, margins = self.bins(batch), _matrix(batch.column("margins"), "float64")
            draws = _draws(batch.column("id").to_numpy(), self.number)
            for m, own in features.items():
                job = self.jobs[m]
                rows = np.flatnonzero((at >= job.train[0]) & (at < job.train[1]) & (y >= 0) & (draws < job.params.row_share))
                place = np.full(len(self.now[m].feature), -1)
                place[self.open[m]] = np.arange(len(self.open[m]))
                mine = bins[rows]
                local = place[self.now[m].leaves(mine)]
                rows, mine, local = rows[local >= 0], mine[local >= 0], local[local >= 0]
                # The late trees' margins are wanted for the rows of open nodes alone.
                p = 1 / (1 + np.exp(-self.late_added(m, margins[rows, m], mine)))
                g, h = np.rint((p - y[rows]) * _UNIT), np.rint(p * (1 - p) * _UNIT)
                if m not in sums:
                    sums[m] = np.zeros((2, len(self.open[m]), len(own), width))
                for k, feature in enumerate(own):
                    cells = local * width + mine[:, feature]
                    for total, values in zip(sums[m], (g, h)):
                        total[:, k] += np.bincount(cells, values, len(self.open[m]) * width).reshape(-1, width)
        for m, (g, h) in ((m, found.reshape(2, -1)) for m, found in sums.items()):
            filled = np.flatnonzero(h)
            node, rest = np.divmod(filled, len(features[m]) * width)
            feature, bin_ = np.divmod(rest, width)
            columns = [np.full(len(filled), m), np.array(self.open[m])[node], features[m][feature], bin_]
            columns = [pa.array(c, pa.int32()) for c in columns] + [pa.array(v[filled].astype("int64")) for v in (g, h)]
            yield pa.RecordBatch.from_arrays(columns, ["model", "node", "feature", "bin", "g", "h"])


def best_splits(cells: DataFrame, params: Sequence[Params]) -> DataFrame:
    """The best split of every (model, node): G and H of the node, gain (null: none), feature, bin, missing_left, gl and hl.

    ``cells`` are gradient and hessian sums per (model, node, feature, bin) in units of 2^-24;
    bin 0 holds rows without a value. Ties go to the first feature, then the lowest bin, then
    missing values on the left.
    """

    def own(name: str) -> Column:
        return F.element_at(F.array(*[F.lit(float(getattr(p, name))) for p in params]), F.col("model") + 1)

    def score(g: Column, h: Column) -> Column:
        shrunk = F.greatest(F.abs(g) - own("l1"), F.lit(0.0))
        return shrunk * shrunk / (h + own("l2"))

    each = ["model", "node", "feature"]
    # One shuffle: a node's cells, bounded by features and bins, stay together to the end.
    sums = cells.repartition("model", "node").groupBy(*each, "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    whole = Window.partitionBy(*each)
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    unit = F.lit(float(_UNIT))

    def without(column: str) -> Column:
        return F.sum(F.when(F.col("bin") == 0, F.col(column)).otherwise(0)).over(whole)

    swept = sums.select(
        *each, "bin",
        *[(F.sum(c).over(whole) / unit).alias(f"{c}_all") for c in "gh"],
        *[(without(c) / unit).alias(f"{c}_none") for c in "gh"],
        *[(F.sum(c).over(upto) / unit).alias(f"{c}_low") for c in "gh"],
    )
    sides = F.explode(F.array(F.lit(True), F.lit(False)))
    sided = swept.select("*", sides.alias("missing_left"))
    for c in "gh":
        sided = sided.withColumn(f"{c}l", F.when(F.col("missing_left"), F.col(f"{c}_low")).otherwise(F.col(f"{c}_low") - F.col(f"{c}_none")))
    right_g, right_h = F.col("g_all") - F.col("gl"), F.col("h_all") - F.col("hl")
    enough = (F.col("hl") >= own("min_child")) & (right_h >= own("min_child")) & (F.col("hl") > 0) & (right_h > 0)
    gain = score(F.col("gl"), F.col("hl")) + score(right_g, right_h) - score(F.col("g_all"), F.col("h_all"))
    gained = sided.withColumn("gain", F.when(enough & (F.col("bin") > 0) & (gain > own("min_gain")), gain))
    order = F.struct("gain", -F.col("feature"), -F.col("bin"), "missing_left")
    chosen = F.max(F.struct(order.alias("order"), "feature", "bin", "missing_left", "gl", "hl", "g_all", "h_all", "gain"))
    best = gained.groupBy("model", "node").agg(chosen.alias("best"))
    return best.select("model", "node", "best.g_all", "best.h_all", "best.gain", "best.feature", "best.bin", "best.missing_left", "best.gl", "best.hl")


def _leaf(params: Params, g: float, h: float) -> float:
    shrunk = np.sign(g) * max(abs(g) - params.l1, 0.0)
    return float(-params.rate * shrunk / (h + params.l2)) if h + params.l2 > 0 else 0.0


def _enter(tree: Tree, p: Params, node: int, g: float, h: float, gain: float | None, feature: int, bin_: int, missing_left: bool, gl: float, hl: float) -> list[int]:
    """Enter a node's best split with its children's values, or without a ``gain`` its own value; the children that may be split."""
    if gain is None:
        tree.value[node] = _leaf(p, g, h)
        return []
    tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node] = feature, bin_, missing_left, gain
    tree.value[2 * node] = _leaf(p, gl, hl)
    tree.value[2 * node + 1] = _leaf(p, g - gl, h - hl)
    return [2 * node, 2 * node + 1] if 4 * node < len(tree.feature) else []


def _sums(bins: np.ndarray, place: np.ndarray, g: np.ndarray, h: np.ndarray, n: int, width: int) -> np.ndarray:
    """(g or h, place, feature, bin): sums of rows in ``n`` places; ``bins`` has a row for each feature."""
    total, first = np.empty((2, n, len(bins), width)), place * width
    for k, own in enumerate(bins):
        cells = first + own
        for part, values in zip(total, (g, h)):
            part[:, k] = np.bincount(cells, values, n * width).reshape(n, width)
    return total


def _best_of(sums: np.ndarray, p: Params) -> list[tuple]:
    """The best split of every place, with the rules and ties of ``best_splits``: G, H, gain (None: none), place of the feature, bin, missing_left, gl, hl."""
    g, h = np.where(sums[1] != 0, sums, 0.0) / _UNIT
    low_g, low_h = g.cumsum(-1), h.cumsum(-1)
    all_g, all_h = low_g[..., -1:, None], low_h[..., -1:, None]
    gl, hl = np.stack([low_g, low_g - g[..., :1]], -1), np.stack([low_h, low_h - h[..., :1]], -1)
    right_g, right_h = all_g - gl, all_h - hl

    def score(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        shrunk = np.maximum(np.abs(g) - p.l1, 0.0)
        return shrunk * shrunk / (h + p.l2)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(gl, hl) + score(right_g, right_h) - score(all_g, all_h)
    good = (h > 0)[..., None] & (hl >= p.min_child) & (right_h >= p.min_child) & (hl > 0) & (right_h > 0) & (gain > p.min_gain)
    good[:, :, 0] = False
    n, width = len(gain), g.shape[-1]
    best = np.where(good, gain, -np.inf).reshape(n, -1).argmax(1)
    feature, rest = np.divmod(best, 2 * width)
    found = []
    for i, (k, b, side) in enumerate(zip(feature.tolist(), (rest // 2).tolist(), (rest % 2).tolist())):
        own = (gain[i, k, b, side], k, b, side == 0, gl[i, k, b, side], hl[i, k, b, side])
        found.append((all_g[i, k, 0, 0], all_h[i, k, 0, 0], *(own if good[i, k, b, side] else (None, *own[1:]))))
    return found


def _grow_alone(p: Params, bins: np.ndarray, ids: np.ndarray, y: np.ndarray, n_bins: int) -> list[Tree]:
    """The trees of one model, given all rows that it learns from."""
    width, margins, trees, turned = n_bins + 1, np.zeros(len(bins)), [], np.ascontiguousarray(bins.T)
    for number in range(p.trees):
        features, tree = _features_of(p, bins.shape[1], number), Tree.empty(p.depth)
        rows = np.flatnonzero(_draws(ids, number) < p.row_share)
        chance = 1 / (1 + np.exp(-margins[rows]))
        g, h = np.rint((chance - y[rows]) * _UNIT), np.rint(chance * (1 - chance) * _UNIT)
        mine, place, nodes = turned[features].take(rows, 1), np.zeros(len(rows), "int64"), [1]
        sums = _sums(mine, place, g, h, 1, width)
        while nodes:
            found, opened, split = _best_of(sums, p), [], np.zeros(len(nodes), bool)
            for i, (node, (g_all, h_all, gain, k, *rest)) in enumerate(zip(nodes, found)):
                if h_all > 0:
                    children = _enter(tree, p, node, float(g_all), float(h_all), gain, int(features[k]), *rest)
                    split[i] = bool(children)
                    opened += children
            nodes = opened
            if not nodes:
                break
            # Rows of split nodes go to a child; the sums of the larger child are what the smaller one leaves of the parent's.
            rows = np.flatnonzero(split[place])
            mine, place, g, h = mine.take(rows, 1), place[rows], g[rows], h[rows]
            feature, bin_, missing_left = (np.array([f[c] for f in found]) for c in (3, 4, 5))
            values = mine[feature[place], np.arange(len(place))]
            left = np.where(values == 0, missing_left[place], values <= bin_[place])
            pair = (np.cumsum(split) - 1)[place]
            place = 2 * pair + ~left
            n = len(nodes) // 2
            many = np.bincount(place, minlength=2 * n).reshape(n, 2)
            small = (many[:, 1] < many[:, 0]).astype("int64")
            few = np.flatnonzero(place == 2 * pair + small[pair])
            less, parents, each = _sums(mine.take(few, 1), pair[few], g[few], h[few], n, width), sums[:, split], np.arange(n)
            sums = np.empty((2, 2 * n, *less.shape[2:]))
            sums[:, 2 * each + small], sums[:, 2 * each + 1 - small] = less, parents - less
        trees.append(tree)
        margins = margins + tree.value[tree.leaves(bins)]
    return trees


def _grow_whole(rows: DataFrame, jobs: Sequence[Job], columns: list[str], cuts: list[np.ndarray], n_bins: int, with_trees: bool) -> tuple[list[list[Tree]], DataFrame]:
    """The trees of every model if asked for, and (row, job, p) of every test row, each model grown in one task."""
    import pyarrow as pa

    spark = rows.sparkSession
    table = rows.select("row", "at", "id", "y", "bins").toArrow().combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
    order = sorted(range(len(jobs)), key=lambda m: -jobs[m].params.trees * jobs[m].params.depth)
    schema = "job int, row long, p double, trees binary"
    target = spark.createDataFrame([], schema)
    arrow = _arrow_schema(target)

    def run(batches):
        whole = pa.ipc.open_stream(shared.value).read_all()
        row, at, ids, y = (whole.column(c).to_numpy() for c in ("row", "at", "id", "y"))
        bins = _matrix(whole.column("bins").chunk(0), "uint8") if len(whole) else np.zeros((0, len(columns)), "uint8")
        for batch in batches:
            for m in (order[k] for k in batch.column("id").to_pylist()):
                job = jobs[m]
                learn = np.flatnonzero((at >= job.train[0]) & (at < job.train[1]) & (y >= 0))
                trees = _grow_alone(job.params, bins[learn], ids[learn], y[learn], n_bins)
                test = np.flatnonzero((at >= job.test[0]) & (at < job.test[1]))
                p = 1 / (1 + np.exp(-Boosted(columns, cuts, job.params, trees).margins(bins[test])))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(test), m, "int32")), pa.array(row[test]), pa.array(p), pa.nulls(len(test), pa.binary())], schema=arrow)
                if with_trees:
                    packed = pa.array([zlib.compress(pickle.dumps(trees), 1)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.float64()), packed], schema=arrow)

    found = _stored(spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(run, target.schema), "grown")
    shared.destroy()
    grown: list[list[Tree]] = [[] for _ in jobs]
    if with_trees:
        for r in found.where(F.col("trees").isNotNull()).select("job", "trees").collect():
            grown[r["job"]] = pickle.loads(zlib.decompress(r["trees"]))
    return grown, found.where(F.col("row").isNotNull()).select("row", "job", "p")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _arrow_schema(df: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def grow(
    df: DataFrame,
    columns: list[str],
    label: str,
    row_id: Column,
    at: Column,
    jobs: Sequence[Job],
    keep: Sequence[str] = (),
    cuts: list[np.ndarray] | None = None,
    with_trees: bool = True,
) -> tuple[list[Boosted], DataFrame]:
    """All models of ``jobs``, and their predictions: ``keep``, ``job`` (place in the list) and ``p``, a row for each test row of a job.

    ``at`` is a row's whole-number position, ``row_id`` a number that decides which trees see the
    row; ``cuts`` are the bounds between bins, by default quantiles. Rows whose boolean ``label`` is null are predicted but not learned from. A model
    without rows to learn from predicts one half. Memory is bounded by growing as many models
    at once as a task has room for. Without ``with_trees`` the models may come without their trees, so that those of
    a search need not come to the driver.
    """
    jobs, columns, keep = list(jobs), list(columns), list(keep)
    if not columns or any(j.params.depth < 1 for j in jobs):
        raise ValueError("at least one feature, and a depth of one")
    cuts = cuts or cuts_of(df, columns)
    width = max(map(len, cuts)) + 1
    own = F.coalesce(F.col(label).cast("int"), F.lit(-1))
    source = df.select(*[F.col(c).alias(f"keep_{c}") for c in keep], at.cast("long").alias("at"), row_id.cast("long").alias("id"), own.alias("y"), *[F.col(c).alias(f"x_{c}") for c in columns])
    kept = [f"keep_{c}" for c in keep]
    source = source.withColumn("row", F.monotonically_increasing_id())
    base = source.select(*kept, "row", "at", "id", "y", F.lit(b"").alias("bins"))
    schema = base.schema
    arrow = _arrow_schema(base)

    def bin_rows(batches):
        import pyarrow as pa

        for batch in batches:
            bins = binned(batch, [f"x_{c}" for c in columns], cuts)
            raw = pa.array([b.tobytes() for b in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*kept, "row", "at", "id", "y")], raw], schema=arrow)

    rows = _stored(source.hint("rebalance").mapInArrow(bin_rows, schema), "bins")
    models, predictions = [Boosted(columns, cuts, j.params) for j in jobs], []
    room = _ROOM // (16 * len(columns) * (width + 1) * max(1 << (j.params.depth - 1) for j in jobs)) if jobs else 0
    if room and rows.count() * (len(columns) + 28) <= _WHOLE:
        grown, scored = _grow_whole(rows, jobs, columns, cuts, width, with_trees)
        for model, trees in zip(models, grown):
            model.trees = trees
        return models, scored.join(rows, "row").select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], "job", "p")
    rows, room = rows.drop("row"), max(1, room)
    for start in range(0, len(jobs), room):
        wave = jobs[start : start + room]
        grown, stored = _grow_wave(rows, wave, len(columns), width)
        for model, trees in zip(models[start:], grown):
            model.trees = trees
        predictions.append(_predictions(stored, wave, start, keep, kept))
    if not predictions:
        return [], source.select(*[F.col(f"keep_{c}").alias(c) for c in keep], F.lit(0).alias("job"), F.lit(0.5).alias("p")).limit(0)
    whole = predictions[0]
    for part in predictions[1:]:
        whole = whole.unionByName(part)
    return models, whole


def _with_margins(rows: DataFrame, growth: _Growth, fresh: bool) -> DataFrame:
    """Rows with the margins of all models, those of the late trees added, stored."""
    names = [c for c in rows.columns if c != "margins"]
    target = rows.select(*names, F.lit(b"").alias("margins"))
    arrow, blank = _arrow_schema(target), bytes(8 * len(growth.jobs))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            raw = [blank] * batch.num_rows if fresh else [m.tobytes() for m in growth.margins(batch)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(raw, pa.binary())], schema=arrow)

    return _stored(rows.mapInArrow(run, target.schema), "margins")


def _renewed(stored: DataFrame, growth: _Growth) -> DataFrame:
    """The stored margins with the late trees' added; the old ones are deleted, or a long search would keep hundreds of them."""
    files = stored.inputFiles()
    fresh = _with_margins(stored, growth, False)
    hadoop, spark = stored.sparkSession._jvm.org.apache.hadoop.fs, stored.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        location = hadoop.Path(folder)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
    return fresh


def _grow_wave(rows: DataFrame, jobs: Sequence[Job], n_features: int, n_bins: int) -> tuple[list[list[Tree]], DataFrame]:
    """The trees of every model, and the rows with their final margins."""
    growth, trees = _Growth(jobs, n_features, n_bins), [[] for _ in jobs]
    stored = _with_margins(rows, growth, True)
    cell = "model int, node int, feature int, bin int, g long, h long"
    params = [j.params for j in jobs]
    for number in range(max(p.trees for p in params)):
        growth.number = number
        for m, p in enumerate(params):
            growing = number < p.trees
            growth.now[m] = Tree.empty(p.depth) if growing else None
            growth.open[m] = [1] if growing else []
        while any(growth.open):
            narrow = stored.select("at", "id", "y", "bins", "margins")
            # One row for each open node: trials, folds and depth bound what comes to the driver.
            found = best_splits(narrow.mapInArrow(copy(growth).histograms, cell), params).collect()
            growth.open = [[] for _ in jobs]
            for r in sorted(found, key=lambda r: (r["model"], r["node"])):
                m = r["model"]
                own = (r[c] for c in ("node", "g_all", "h_all", "gain", "feature", "bin", "missing_left", "gl", "hl"))
                growth.open[m] += _enter(growth.now[m], params[m], *own)
        for m, tree in enumerate(growth.now):
            if tree is not None:
                trees[m].append(tree)
                growth.late[m].append(tree)
        if (number + 1) % _KEPT_BACK == 0:
            stored = _renewed(stored, growth)
            growth.late = [[] for _ in jobs]
    if any(growth.late):
        stored = _renewed(stored, growth)
    return trees, stored


def _predictions(stored: DataFrame, jobs: Sequence[Job], first: int, keep: list[str], kept: list[str]) -> DataFrame:
    target = stored.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], F.lit(0).alias("job"), F.lit(0.5).alias("p"))
    arrow = _arrow_schema(target)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column("at").to_numpy()
            margins = _matrix(batch.column("margins"), "float64")
            for m, job in enumerate(jobs):
                rows = np.flatnonzero((at >= job.test[0]) & (at < job.test[1]))
                if len(rows):
                    own = batch.take(pa.array(rows))
                    p = 1 / (1 + np.exp(-margins[rows, m]))
                    columns = [*[own.column(k) for k in kept], pa.array(np.full(len(rows), first + m, "int32")), pa.array(p)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return stored.mapInArrow(run, target.schema)


def predict(model: Boosted, df: DataFrame, out: str = "p") -> DataFrame:
    """``df`` with the probability ``out`` of a true label."""
    target = df.select(*df.columns, F.lit(0.5).alias(out))
    arrow = _arrow_schema(target)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            margins = model.margins(binned(batch, model.columns, model.cuts))
            columns = [*batch.columns, pa.array(1 / (1 + np.exp(-margins)))]
            yield pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, target.schema)
