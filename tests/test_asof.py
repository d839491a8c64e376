"""As-of joins against a plain search, across the borders of pieces."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from tidecast.operators.asof import asof_join


def plain(left, right, same, tolerance):
    told = {}
    for k, t, tie, v in sorted((r for r in right if r[0] is not None and r[1] is not None), key=lambda r: r[1:3]):
        told.setdefault(k, []).append((t, tie, v))
    found = []
    for n, k, t in left:
        own = told.get(k, []) if t is not None else []
        at = bisect.bisect_right(own, (t, float("inf"))) if same and own else bisect.bisect_left(own, (t,)) if own else 0
        hit = own[at - 1] if at else None
        if hit and tolerance is not None and t - hit[0] > tolerance:
            hit = None
        found.append((n, hit and hit[2], hit and hit[0]))
    return sorted(found)


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("tolerance", [None, 5])
def test_matches_equal_a_plain_search(spark, same, tolerance):
    rng = random.Random(4)
    key = lambda: rng.choice(["hot"] * 8 + ["b", "c", None])
    left = [(n, key(), None if n % 50 == 3 else rng.randint(0, 300)) for n in range(900)]
    right = [(key(), None if n % 60 == 1 else rng.randint(0, 300), n, n * 10) for n in range(250)]
    a = spark.createDataFrame(left, "n long, k string, t long").repartition(3)
    b = spark.createDataFrame(right, "k string, t long, tie long, v long")
    for pieces in (1, 16):
        got = asof_join(a, b, ["k"], "t", ["v"], "tie", same, None if tolerance is None else F.lit(tolerance), pieces=pieces)
        assert sorted((r["n"], r["v"], r["matched_time"]) for r in got.collect()) == plain(left, right, same, tolerance)


def test_a_hot_key_and_a_hot_instant_lie_in_many_pieces(spark, tmp_path):
    path = f"{tmp_path}/hot"
    spark.range(60_000).select(F.lit("k").alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("t"), "id").write.parquet(path)
    left = spark.read.parquet(path)
    right = left.where("id % 100 = 0").select("k", "t", F.col("id").alias("v"))
    got = asof_join(left, right, ["k"], "t", ["v"], "v", pieces=12)
    text = got._jdf.queryExecution().executedPlan().toString()
    stored = spark.read.parquet(text[text.index("file:") : text.index("]", text.index("file:"))].split(",")[0])
    sizes = [r["count"] for r in stored.groupBy("_piece").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 3 * sum(sizes) / len(sizes)
    assert got.count() == 60_000


def test_empty_sides_and_clashes(spark):
    a = spark.createDataFrame([(1, 5)], "k long, t long")
    b = spark.createDataFrame([], "k long, t long, v string")
    assert [tuple(r) for r in asof_join(a, b, ["k"], "t", ["v"]).collect()] == [(1, 5, None, None)]
    assert asof_join(a.limit(0), b, ["k"], "t", ["v"]).collect() == []
    with pytest.raises(ValueError):
        asof_join(b, b, ["k"], "t", ["v"])
