"""Rules that hold for any data, and the skew-safe operators against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import day
from tidecast import fixtures as fx
from tidecast.operators import calendar, evaluate, folds, ledger, sentiment, skew
from tidecast.plans import catalog, daily_job
from tidecast.plans import feature_table as flagship
from tidecast.sources import writers

KEY = ["series_id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one group, NULL groups, and a unique id."""
    rng = random.Random(7)
    data = [
        (rng.choice(["hot"] * 6 + ["a", "b", None]), day(rng.randint(1, 3)), i, rng.random())
        for i in range(1500)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, date date, id long, p double").repartition(6)


def test_top_n_in_two_rounds_is_the_plain_top_n(skewed, rows):
    plain = Window.partitionBy("k").orderBy(F.desc("p"), "id")
    expected = skewed.withColumn("r", F.row_number().over(plain)).where("r <= 40").drop("r")
    got = skew.top_n_per_group(skewed, ["k"], [F.desc("p"), F.col("id")], 40, "id", salts=7)
    assert rows(got) == rows(expected)


def test_numbering_by_pieces_is_the_plain_row_number(skewed, rows):
    plain = Window.partitionBy("k").orderBy("date", "id")
    expected = skewed.withColumn("rn", F.row_number().over(plain))
    got = skew.number_rows(skewed, ["k"], "date", "id", pieces=7)
    assert rows(got, "id", "rn") == rows(expected, "id", "rn")


def test_first_per_group_is_the_plain_first(skewed, rows):
    plain = Window.partitionBy("k").orderBy("p", "id")
    expected = skewed.withColumn("r", F.row_number().over(plain)).where("r = 1").drop("r")
    assert rows(skew.first_per_group(skewed, ["k"], [F.col("p"), F.col("id")])) == rows(expected)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_spread_join_is_the_plain_join(spark, skewed, rows, how, threshold):
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), (None, 4)], "name string, v int")
    expected = skewed.join(lookup, skewed["k"] == lookup["name"], how).drop("name")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = skew.spread_join(skewed, lookup, "k", "name", "id", how)
        assert rows(got) == rows(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_windowed_accuracy_is_the_plain_loop(skewed):
    df = skewed.where("k IS NOT NULL").withColumn("actual", F.col("id") % 2 == 0)
    got = {r["k"]: r for r in evaluate.windowed_accuracy(df, ["k"], "id").collect()}
    for k, row in got.items():
        items = sorted((r["date"], r["id"], (r["p"] > 0.5) == r["actual"]) for r in df.where(F.col("k") == k).collect())
        hits = [i[2] for i in items]
        runs = [sum(hits[i : i + 7]) / len(hits[i : i + 7]) for i in range(0, len(hits), 7)]
        mean = sum(runs) / len(runs)
        assert row["mean_acc"] == pytest.approx(mean)
        assert row["std_acc"] == pytest.approx((sum((x - mean) ** 2 for x in runs) / len(runs)) ** 0.5)


def test_sample_is_whole_when_small_and_repeatable(skewed, rows):
    df = skewed.where("k IS NOT NULL")
    assert sentiment.sample_per_day(df, ["k"], 10_000, "id").count() == df.count()
    first = rows(sentiment.sample_per_day(df, ["k"], 9, "id"), "id")
    assert first == rows(sentiment.sample_per_day(df.repartition(3), ["k"], 9, "id"), "id")
    assert len(first) <= 9 * 9


@pytest.mark.parametrize("train,test,gap", [(10, 3, 0), (7, 1, 2), (5, 9, 1)])
def test_folds(spark, train, test, gap):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(60)]
    df = spark.createDataFrame([(d,) for d in days if d.day % 5], "date date")
    first, last = dt.date(2024, 1, 20), dt.date(2024, 2, 29)
    table = {r["fold_id"]: r for r in folds.table(spark, first, last, train, test, gap).collect()}
    got = {}
    for r in folds.assign(df, first, last, train, test, gap).collect():
        got.setdefault((r["fold_id"], r["role"]), set()).add(r["date"])
    present = {r["date"] for r in df.collect()}
    for k, f in table.items():
        assert (f["end_train"] - f["start_train"]).days == train
        in_train = {d for d in present if f["start_train"] <= d < f["end_train"]}
        in_test = {d for d in present if f["start_test"] <= d < f["end_test"]}
        assert got.get((k, "train"), set()) == in_train
        assert got.get((k, "test"), set()) == in_test
        assert not in_train & in_test
    assert {k for k, _ in got} <= set(table)
    starts = sorted(f["start_test"] for f in table.values())
    assert all((b - a).days == test for a, b in zip(starts, starts[1:]))
    assert starts[-1] <= last < starts[-1] + dt.timedelta(test)


def test_spine_has_period_plus_one_days_per_series(spark, sf_dir):
    got = calendar.spine(fx.close(spark, sf_dir), KEY, catalog.TODAY, 9).groupBy("series_id").count()
    assert {r["count"] for r in got.collect()} == {10}


def test_merging_twice_is_merging_once(spark, sf_dir, rows):
    trends = fx.trends(spark, sf_dir)
    stored = trends.where(F.col("date") <= day(10))
    new = trends.where(F.col("date") >= day(8)).withColumn("trends", F.lit(7).cast("long"))
    on = [*KEY, "date"]
    for merge in (writers.insert_if_absent, writers.upsert):
        once = merge(new, stored, on)
        assert rows(once, *on, "trends") == rows(merge(new, once, on), *on, "trends")


def test_ledger_append_twice_is_once(spark, sf_dir, rows):
    prices, made = fx.prices(spark, sf_dir), fx.predictions(spark, sf_dir)
    new = ledger.outcomes(prices, made, KEY)
    once = ledger.append(new, new.limit(0), KEY)
    assert rows(ledger.append(new, once, KEY)) == rows(once) == rows(new)


def test_features_do_not_look_ahead(spark, sf_dir, rows):
    cut = day(20)

    def table(limit):
        def past(df):
            return df.where(F.col("date") <= limit) if limit else df

        posts = past(fx.posts(spark, sf_dir))
        inputs = flagship.Inputs(
            posts=posts,
            influencer_posts=posts,
            influencers=fx.influencers(spark, sf_dir),
            close=past(fx.close(spark, sf_dir)),
            trends=past(fx.trends(spark, sf_dir)),
            metrics=past(fx.metric_points(spark, sf_dir)),
        )
        built = flagship.build(inputs, KEY, catalog.TODAY, catalog.PERIOD, fx.SOURCES, fx.METRICS)
        return rows(built.where(F.col("date") <= cut).drop("is_price_up"))

    assert table(None) == table(cut)


def test_aspect_counts_of_a_text_sum_to_the_aspects(spark, sf_dir):
    rows = fx.words(fx.articles(spark, sf_dir))
    got = sentiment.lexicon_polarity(rows, ["doc_id"], fx.lexicon(spark)).groupBy("doc_id").count()
    assert {r["count"] for r in got.collect()} == {5}
    assert got.count() == rows.count()


def test_ledger_update_scores_replaces_and_refreshes(spark, sf_dir, rows):
    record = spark.createDataFrame(
        [("s0", day(30), day(31), 12.0, "Down", 3, 1, 9)],
        "series_id string, utc_date date, date date, reference_price double, "
        "tomorrow_prediction string, twitter_positive_sentiment long, "
        "twitter_negative_sentiment long, google_trends long",
    )
    stored = daily_job.Ledger(
        results=spark.createDataFrame(
            [],
            "series_id string, datetime string, price double, day int, price_diff double, outcome string",
        ),
        current=spark.createDataFrame(
            [("s0", "31/01/2024", 10.0, "Up", 0, 0, 0)],
            "series_id string, target_date string, reference_price double, prediction string, "
            "positive long, negative long, trends long",
        ),
        sentiment=None,
        trends=None,
    )
    totals = sentiment.polarity_totals(fx.posts(spark, sf_dir), KEY)
    updated = daily_job.update_ledger(record, stored, totals, fx.trends(spark, sf_dir), KEY)
    assert rows(updated.results) == [("s0", "2024-01-31 07:00:00", 12.0, 31, 2.0, "Correct")]
    assert rows(updated.current) == [("s0", "01/02/2024", 12.0, "Down", 3, 1, 9)]
    assert updated.sentiment.select("date").distinct().count() == 7
    again = daily_job.update_ledger(record, updated, totals, fx.trends(spark, sf_dir), KEY)
    assert rows(again.results) == rows(updated.results)
    assert rows(again.current) == rows(updated.current)
