"""Boosted trees against a brute-force version, alone and together."""

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidecast.operators import boosting
from tidecast.operators.boosting import Job, Params, Tree

COLUMNS = ["a", "b", "c", "empty"]


@pytest.fixture(scope="module")
def table(spark):
    """Rows with a numeric, a skewed and a coarse feature, missing values, and one feature that is never known."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(600):
        a, b, c = rng.normal(), rng.exponential() ** 3, int(rng.integers(0, 4))
        y = bool(a + 0.3 * c - 0.2 * min(b, 3) + 0.3 * rng.normal() > 0.2)
        rows.append((k, None if k % 11 == 0 else float(a), float("nan") if k % 13 == 0 else float(b), c, None, None if k % 50 == 7 else y))
    schema = "id long, a double, b double, c int, empty double, y boolean"
    return spark.createDataFrame(rows, schema).repartition(5), rows


def shrunk(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def brute_force(rows, cuts, job):
    """Every split of every node tried, from the same bins, draws and rounded gradients; margins of all rows."""
    p, unit = job.params, 1 << 24

    def bin_of(k, value):
        return 0 if value is None or value != value else 1 + sum(c < value for c in cuts[k])

    bins = [[bin_of(k, r[k + 1]) for k in range(4)] for r in rows]
    margins, structure = [0.0] * len(rows), []
    for t in range(p.trees):
        draws = boosting._draws(np.array([r[0] for r in rows]), t)
        own = boosting._features_of(p, 4, t)
        learn = [i for i, r in enumerate(rows) if job.train[0] <= r[0] < job.train[1] and r[5] is not None and draws[i] < p.row_share]
        chance = [1 / (1 + np.exp(-m)) for m in margins]
        g = {i: float(np.rint((chance[i] - rows[i][5]) * unit)) / unit for i in learn}
        h = {i: float(np.rint(chance[i] * (1 - chance[i]) * unit)) / unit for i in learn}

        def split(inside, everyone, depth, at):
            total_g, total_h = sum(g[i] for i in inside), sum(h[i] for i in inside)

            def score(s, z):
                return shrunk(s, p.l1) ** 2 / (z + p.l2)

            best = None
            for k in own if depth < p.depth else []:
                for cut in sorted({bins[i][k] for i in inside} - {0}):
                    for missing_left in (True, False):
                        left = [i for i in inside if (missing_left if bins[i][k] == 0 else bins[i][k] <= cut)]
                        gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                        gr, hr = total_g - gl, total_h - hl
                        if hl < p.min_child or hr < p.min_child or hl <= 0 or hr <= 0:
                            continue
                        gain = score(gl, hl) + score(gr, hr) - score(total_g, total_h)
                        if gain > p.min_gain and (best is None or gain > best[0]):
                            best = (gain, k, cut, missing_left)
            if best is None:
                if inside:
                    for i in everyone:
                        margins[i] += -p.rate * shrunk(total_g, p.l1) / (total_h + p.l2)
                return
            _, k, cut, missing_left = best
            structure.append((t, at, int(k), cut, missing_left))
            goes_left = lambda i: missing_left if bins[i][k] == 0 else bins[i][k] <= cut
            for side, child in ((True, 2 * at), (False, 2 * at + 1)):
                split([i for i in inside if goes_left(i) == side], [i for i in everyone if goes_left(i) == side], depth + 1, child)

        split(learn, list(range(len(rows))), 0, 1)
    return margins, sorted(structure)


def splits_of(model):
    found = []
    for t, tree in enumerate(model.trees):
        for node in np.flatnonzero(tree.feature >= 0).tolist():
            found.append((t, node, int(tree.feature[node]), int(tree.bin[node]), bool(tree.missing_left[node])))
    return sorted(found)


JOBS = [
    Job(Params(trees=3, depth=3, rate=0.3, row_share=0.8, column_share=1.0, l1=0.0, l2=1.0), (0, 400), (400, 500)),
    Job(Params(trees=2, depth=2, rate=0.5, row_share=1.0, column_share=0.5, min_gain=2.0, l1=0.7, l2=0.1, min_child=3.0), (100, 600), (0, 100)),
    Job(Params(trees=3, depth=3, rate=0.3, row_share=0.8, column_share=1.0, l1=0.0, l2=1.0), (200, 600), (0, 200)),
    Job(Params(trees=1, depth=2), (5000, 6000), (0, 10)),
]


@pytest.fixture(scope="module")
def together(table):
    models, scored = boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), JOBS, ["id"])
    return models, {(r["job"], r["id"]): r["p"] for r in scored.collect()}


@pytest.mark.parametrize("k", range(3))
def test_splits_and_leaves_equal_brute_force(table, together, k):
    model = together[0][k]
    margins, structure = brute_force(table[1], [c.tolist() for c in model.cuts], JOBS[k])
    assert splits_of(model) == structure != []
    assert len({s[2] for s in structure}) > 1
    for i in range(*JOBS[k].test):
        assert together[1][k, i] == pytest.approx(1 / (1 + math.exp(-margins[i])), abs=1e-9)


def test_models_grown_together_equal_those_grown_alone(table, together):
    for k, job in enumerate(JOBS):
        (alone,), scored = boosting.grow(table[0].coalesce(1), COLUMNS, "y", F.col("id"), F.col("id"), [job], ["id"])
        assert splits_of(alone) == splits_of(together[0][k])
        assert {r["id"]: r["p"] for r in scored.collect()} == {i: p for (m, i), p in together[1].items() if m == k}
    assert {together[1][3, i] for i in range(10)} == {0.5}


def test_a_model_scores_new_rows_as_it_scored_its_own(table, together):
    got = boosting.predict(together[0][0], table[0]).where("id >= 400 AND id < 500").collect()
    assert {r["id"]: r["p"] for r in got} == pytest.approx({i: p for (m, i), p in together[1].items() if m == 0})
    shares = together[0][0].importance()
    assert sum(shares.values()) == pytest.approx(1) and shares["empty"] == 0 < shares["a"]


def test_jobs_do_not_grow_with_folds(spark, table):
    def launched(folds):
        tracker, group = spark.sparkContext.statusTracker(), f"folds-{folds}"
        spark.sparkContext.setJobGroup(group, "count")
        jobs = [Job(Params(trees=2, depth=2), (10 * k, 10 * k + 300)) for k in range(folds)]
        boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), jobs)
        spark.sparkContext.setJobGroup(None, None)
        return len(tracker.getJobIdsForGroup(group))

    assert launched(12) == launched(1) > 0


def test_models_beyond_a_task_s_room_grow_in_waves(table, together, monkeypatch):
    monkeypatch.setattr(boosting, "_ROOM", 1)
    models, scored = boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), JOBS, ["id"])
    assert [splits_of(m) for m in models] == [splits_of(m) for m in together[0]]
    assert {(r["job"], r["id"]): r["p"] for r in scored.collect()} == together[1]


def test_empty_tables_and_no_jobs(table):
    none = table[0].limit(0)
    models, scored = boosting.grow(none, COLUMNS, "y", F.col("id"), F.col("id"), JOBS[:1], ["id"])
    assert splits_of(models[0]) == [] and scored.collect() == []
    assert boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), [], ["id"])[1].collect() == []
    assert boosting.predict(models[0], none).collect() == []


def test_late_trees_are_only_asked_for_rows_that_are_learned_from(monkeypatch):
    asked, leaves = [], Tree.leaves
    monkeypatch.setattr(Tree, "leaves", lambda self, bins: (asked.append(len(bins)), leaves(self, bins))[1])
    rng = np.random.default_rng(2)
    bins, margins = rng.integers(0, 5, (1000, 3)).astype("uint8"), rng.normal(size=(1000, 1))
    batch = pa.RecordBatch.from_pydict(
        {
            "at": np.arange(1000) // 100, "id": np.arange(1000), "y": pa.array(np.arange(1000) % 2, pa.int32()),
            "bins": pa.array([b.tobytes() for b in bins], pa.binary()), "margins": pa.array([m.tobytes() for m in margins], pa.binary()),
        }
    )
    late = Tree.empty(1)
    late.feature[1], late.bin[1], late.value[2:] = 1, 2, (0.3, -0.2)
    growth = boosting._Growth([Job(Params(depth=1, row_share=1.0, column_share=1.0), (0, 2))], 3, 5)
    growth.late, growth.now, growth.open = [[late] * 4], [Tree.empty(1)], [[1]]
    cells = pa.Table.from_batches(growth.histograms([batch.slice(0, 150), batch.slice(150)])).to_pylist()
    assert sum(asked) == 5 * 200
    own = margins[:200, 0] + 4 * np.where(bins[:200, 1] <= 2, 0.3, -0.2) * (bins[:200, 1] > 0) + 4 * -0.2 * (bins[:200, 1] == 0)
    p = 1 / (1 + np.exp(-own))
    for f in range(3):
        for b in range(5):
            want = np.rint((p - np.arange(200) % 2) * (1 << 24))[bins[:200, f] == b].sum()
            assert sum(c["g"] for c in cells if (c["feature"], c["bin"]) == (f, b)) == pytest.approx(want, abs=200)


def test_models_grown_in_one_task_equal_those_grown_over_all(table, together, monkeypatch):
    monkeypatch.setattr(boosting, "_WHOLE", 0)
    monkeypatch.setattr(boosting, "_KEPT_BACK", 2)
    models, scored = boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), JOBS, ["id"])
    for model, other in zip(models, together[0]):
        assert len(model.trees) == len(other.trees)
        for tree, same in zip(model.trees, other.trees):
            assert all(np.array_equal(getattr(tree, c), getattr(same, c)) for c in ("feature", "bin", "missing_left", "value", "gain"))
    assert {(r["job"], r["id"]): r["p"] for r in scored.collect()} == together[1]


def test_a_long_search_over_a_small_table_takes_no_pass_for_each_level(spark, table):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("long", "count")
    job = Job(Params(trees=400, depth=4, rate=0.05), (0, 400), (400, 410))
    (grown,), scored = boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), [job], ["id"])
    assert len(scored.collect()) == 10 and len(grown.trees) == 400
    spark.sparkContext.setJobGroup(None, None)
    assert len(tracker.getJobIdsForGroup("long")) < 20


def test_old_margins_are_deleted(spark, table, monkeypatch, tmp_path):
    monkeypatch.setattr(boosting, "_WHOLE", 0)
    monkeypatch.setattr(boosting, "_KEPT_BACK", 1)
    numbers = itertools.count()
    monkeypatch.setattr(boosting, "scratch_dir", lambda session, label: f"{tmp_path}/{label}-{next(numbers)}")
    _, scored = boosting.grow(table[0], COLUMNS, "y", F.col("id"), F.col("id"), JOBS[:1], ["id"])
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("margins")]) == 1 and scored.count() == 100
