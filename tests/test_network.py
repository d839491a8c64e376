"""The text network: gradients, learning, resuming and odd texts."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import model, network
from tidecast.operators.network import Network, Shape

SMALL = Shape(classes=2, buckets=512, width=8, hidden=8, steps=30, rate=0.05, keep_every=10)


def test_slopes_equal_differences():
    shape = Shape(classes=3, buckets=7, width=4, hidden=5)
    rng = np.random.default_rng(1)
    weights = rng.normal(size=len(shape.start()))
    ids, ends, labels = np.array([0, 3, 3, 6, 2]), np.array([3, 3, 5]), np.array([0, 2, 1])

    def loss(w):
        return -np.log(Network(shape, w).chances(ids, ends)[np.arange(3), labels]).sum()

    found = Network(shape, weights).slopes(ids, ends, labels)
    for at in range(len(weights)):
        step = np.zeros_like(weights)
        step[at] = 1e-6
        assert found[at] == pytest.approx((loss(weights + step) - loss(weights - step)) / 2e-6, abs=1e-5)


@pytest.fixture(scope="module")
def pairs(spark, tmp_path_factory):
    """A text is of class 1 if it has exactly one of two words, which no weight per word can tell."""
    rng = random.Random(5)
    plain, rows = [f"w{k}" for k in range(12)], []
    for k in range(480):
        words = rng.choices(plain, k=2)
        has = (k % 4 in (1, 3), k % 4 in (2, 3))
        words += ["alpha"] * has[0] + ["beta"] * has[1]
        rng.shuffle(words)
        rows.append((k, " ".join(words), int(has[0] != has[1])))
    path = f"{tmp_path_factory.mktemp('pairs')}/p"
    spark.createDataFrame(rows, "id int, content string, label int").repartition(4).write.parquet(path)
    return spark.read.parquet(path)


def accuracy(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]


def test_better_than_the_linear_model_on_held_out_texts(pairs):
    learn, held = pairs.where("id < 320"), pairs.where("id >= 320")
    linear = model.classify_text(model.fit_text(learn), held)
    found = network.classify(network.fit(learn, Shape(classes=2, buckets=512, width=8, hidden=8, steps=60)), held)
    assert accuracy(found) >= 0.95 > 0.8 > accuracy(linear)
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 for r in found.collect())


def test_a_fit_goes_on_from_its_last_complete_step(pairs, tmp_path):
    whole = network.fit(pairs, SMALL)
    path = f"{tmp_path}/state"
    network.fit(pairs, SMALL, path=path, until=15)
    (tmp_path / "state" / "step=000020").mkdir()
    resumed = network.fit(pairs, SMALL, path=path)
    assert np.array_equal(whole.weights, resumed.weights)
    assert np.array_equal(network.fit(pairs, SMALL, path=path).weights, whole.weights)
    assert not np.array_equal(network.fit(pairs, Shape(**{**SMALL.__dict__, "seed": 1})).weights, whole.weights)


def test_odd_texts_and_labels(spark):
    rows = [(1, None, "a", 0), (2, "", "b", 1), (3, "word " * 5000, None, None), (4, "one two", "a", 7), (5, "one two", "a", -1)]
    df = spark.createDataFrame(rows, "id int, content string, pair string, label int")
    found = network.fit(df, Shape(classes=2, buckets=16, width=2, hidden=2, steps=2), pair_col="pair")
    got = {r["id"]: r for r in network.classify(found, df, pair_col="pair").collect()}
    assert sorted(got) == [1, 2, 3, 4, 5] and got[1]["probabilities"] == got[2]["probabilities"]
    assert got[4]["probabilities"] != got[1]["probabilities"]
    blank = Shape(classes=2, buckets=16, width=2, hidden=2, steps=2)
    assert np.array_equal(network.fit(df.limit(0), blank).weights, blank.start())
    assert network.classify(found, df.limit(0)).collect() == []


def test_gradient_of_many_words_takes_little_memory():
    shape = Shape(classes=2, buckets=4096)
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 1000, 3000)
    ids, ends = rng.integers(0, shape.buckets, lengths.sum()).astype("int32"), np.cumsum(lengths)
    labels = rng.integers(0, 2, len(ends))
    found = Network(shape, shape.start())
    tracemalloc.start()
    slopes = found.slopes(ids, ends, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    # The same in pieces of a few rows, and in buckets that most blocks do not fill.
    parts = [found.slopes(ids[a and ends[a - 1] : ends[min(a + 7, 3000) - 1]], ends[a : a + 7] - (a and ends[a - 1]), labels[a : a + 7]) for a in range(0, 3000, 7)]
    assert np.allclose(slopes, sum(parts), rtol=0, atol=1e-9)


def test_words_may_be_split_before_and_texts_left_behind(pairs):
    fitted = network.fit(pairs, SMALL, until=2)
    split = pairs.withColumn("words", F.split("content", " ")).drop("content")
    assert np.array_equal(network.fit(split, SMALL, until=2, text_col="words").weights, fitted.weights)
    whole = {r["id"]: r["probabilities"] for r in network.classify(fitted, pairs).collect()}
    narrow = network.classify(fitted, split, text_col="words", keep=["id"])
    assert narrow.columns == ["id", "prediction", "probabilities"]
    assert {r["id"]: r["probabilities"] for r in narrow.collect()} == whole


def test_linear_model_reads_its_texts_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    df = spark.createDataFrame([(f"w{k % 5} w{k % 3}", float(k % 2)) for k in range(40)], "content string, label double")
    model.fit_text(df.select(read("content").alias("content"), "label"))
    assert seen.value == 40
