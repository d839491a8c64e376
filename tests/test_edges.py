"""Hand-written cases for the rules that generated data does not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidecast.functions import reltime, scoring, text
from tidecast.operators import (
    calendar,
    checks,
    evaluate,
    features,
    folds,
    influence,
    ledger,
    sentiment,
    series,
    social,
)
from tidecast.sources import daily, pages, writers

KEY = ["series_id"]


def prices(spark, *values, start=1):
    data = [("a", day(start + i), float(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(data, "series_id string, date date, close_price double")


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first()["x"]


def test_score_of_a_day_without_documents_is_zero(spark):
    score = scoring.polarity_score(F.col("p"), F.col("n"), F.col("o"))
    assert one(spark, score, p=0, n=0, o=0) == 0.0
    assert one(spark, score, p=3, n=1, o=4) == 0.25


def test_label_and_return_go_over_the_rows_present(spark, rows):
    df = prices(spark, 1.0, None, 3.0, 3.0)
    labelled = series.up_label(series.log_return(df, KEY), KEY)
    got = labelled.orderBy("date").collect()
    assert [r["is_price_up"] for r in got] == [True, False, None]
    assert got[0]["price_diff"] is None
    assert got[1]["price_diff"] == pytest.approx(0.8472978603872037)


def test_window_is_period_plus_two_days_and_drops_its_first(spark):
    assert calendar.window_bounds("2024-01-31", 5) == (day(24), day(30))
    assert calendar.spine(prices(spark, 1.0), KEY, "2024-01-31", 5).count() == 6


def test_fill_adds_missing_days_and_drops_days_outside(spark, rows):
    df = series.up_label(prices(spark, 1.0, 2.0, None, 4.0), KEY)
    days = calendar.days_between(df, KEY, day(2), day(4))
    filled = calendar.fill(df, days, KEY, ["close_price"], ["is_price_up"])
    assert rows(filled) == [
        ("a", day(2), 2.0, True),
        ("a", day(3), 0.0, None),
        ("a", day(4), 4.0, None),
    ]


def test_outer_join_keeps_calendar_days_only(spark, rows):
    left = spark.createDataFrame([("a", day(1), 5)], "series_id string, date date, x int")
    right = spark.createDataFrame(
        [("a", day(2), True), ("b", day(9), False)], "series_id string, date date, is_price_up boolean"
    )
    days = calendar.days_between(left, KEY, day(1), day(2))
    built = features.build([left, right], days, KEY)
    assert rows(built) == [("a", day(1), 5, None), ("a", day(2), 0, True)]


def test_non_features_go_by_name(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 4)], ["total_docs", "sentiment_x", "influencer_appearances", "twitter_score"]
    )
    assert features.drop_non_features(df).columns == ["influencer_appearances", "twitter_score"]


def test_null_title_gives_null_content_unless_the_source_has_none(spark, rows):
    df = spark.createDataFrame(
        [("cnn", None, "x"), ("cnn", "t", "x"), ("twitter", None, "y")],
        "media string, title string, article string",
    )
    assert rows(sentiment.content(df, ["twitter"]), "content") == [("t x",), ("y",), (None,)]
    assert rows(sentiment.content(df.drop("title")), "content") == [("x",), ("x",), ("y",)]


def test_all_aspects_are_in_a_record_and_unseen_polarities_are_not(spark):
    df = spark.createDataFrame(
        [(day(1), "ECONOMY", "POSITIVE")] * 2, "date date, aspect string, polarity string"
    )
    row = sentiment.records(df, []).first()
    assert row["total_docs"] == 2
    assert row["sentiment"] == {
        "ECONOMY": {"POSITIVE": 2},
        "TECHNOLOGY": {},
        "GENERAL": {},
        "COMMUNITY": {},
        "SECURITY": {},
    }


def test_first_class_wins_a_tie(spark):
    label = scoring.argmax_label(F.col("p"), scoring.POLARITIES)
    assert one(spark, label, p=[0.2, 0.4, 0.4]) == "NEGATIVE"


def test_encoding_pads_cuts_and_keeps_the_pair(spark):
    vocab = spark.createDataFrame([("a", 2, 3), ("b", 1, 4)], ["token", "n", "token_id"])
    df = spark.createDataFrame([(1, "a b z a a", "b"), (2, "", "b")], ["id", "content", "pair"])
    plain = {r["id"]: r for r in sentiment.encode(df, "id", vocab, 6).collect()}
    assert plain[1]["input_ids"] == [3, 4, 1, 3, 3, 0]
    assert plain[1]["attention_mask"] == [1, 1, 1, 1, 1, 0]
    assert plain[2]["input_ids"] == [0] * 6
    paired = {r["id"]: r["input_ids"] for r in sentiment.encode(df, "id", vocab, 5, pair_col="pair").collect()}
    assert paired == {1: [3, 4, 1, 2, 4], 2: [2, 4, 0, 0, 0]}


def test_normalised_text(spark):
    cases = {
        "I cannot go": "I can not go",
        "don't stop": "do n't stop",
        "it’s @me at www.x.y": "it 's @USER at HTTPURL",
        "at 5 a . m . now 🚀": "at 5 a.m. now :rocket:",
        "  a b\r\nc d ": "a b c d",
        "🚀🚀 up": "🚀🚀 up",
    }
    for said, meant in cases.items():
        assert one(spark, text.normalize(F.col("x")), x=said) == meant


def test_mentions_are_unicode_and_null_when_absent(spark):
    assert one(spark, text.mentions(F.col("x")), x="@josé, @b_1!") == ["@josé", "@b_1"]
    assert one(spark, text.hashtags(F.col("x")), x="none") is None


def test_lines(spark):
    trimmed = text.trim_lines(F.col("x"))
    assert one(spark, trimmed, x="a\nb\nc\nd\ne") == "b\nc"
    assert one(spark, trimmed, x="a\nb\nc") == ""
    assert tuple(one(spark, text.three_lines(F.col("x")), x="t\nd\na")) == ("t", "d", "a")
    assert tuple(one(spark, text.three_lines(F.col("x")), x="t\nd")) == (None, None, None)
    assert one(spark, text.cut_at(F.col("x")), x="a Image Credits b Image Credits") == "a "


def test_unclosed_paragraphs_end_at_the_next(spark):
    html = '<script>var t="<p>no</p>"</script><h1 class="x">A &amp; B</h1><p>one<br>two<p>x</p>tail'
    assert one(spark, text.page_headline(F.col("h")), h=html) == "A & B"
    assert one(spark, text.page_paragraphs(F.col("h")), h=html) == "one\ntwo\nx"


def test_relative_times(spark):
    at = dt.datetime(2024, 3, 31, 12, 0)
    cases = {
        "1 month ago": dt.datetime(2024, 2, 29, 12, 0),
        "2 years ago": dt.datetime(2022, 3, 31, 12, 0),
        "1 day 2 hours ago": dt.datetime(2024, 3, 31, 10, 0),
        "5 mins ago": dt.datetime(2024, 3, 31, 11, 55),
        "3 weeks ago": dt.datetime(2024, 3, 10, 12, 0),
        "2024-01-02 03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5),
        "soon": None,
    }
    df = spark.createDataFrame([(at, s) for s in cases], "at timestamp_ntz, said string")
    got = df.select("said", reltime.resolve(F.col("at"), F.col("said")).alias("x")).collect()
    assert {r["said"]: r["x"] for r in got} == cases


def test_loose_numbers(spark):
    assert one(spark, reltime.decimal_comma(F.col("x")), x="12,5") == 12.5
    assert one(spark, reltime.decimal_comma(F.col("x")), x="n/a") is None
    assert tuple(one(spark, reltime.year_month(F.col("x")), x="2022/ 03/01")) == (2022, 3)


def test_influence_counts_doubled_handles_and_zero_days(spark, rows):
    listed = spark.createDataFrame([("x", 2.0), ("x", 3.0), (None, 9.0)], "handle string, rank double")
    posts = spark.createDataFrame(
        [(1, day(1), "x"), (2, day(1), "x"), (3, day(2), "y"), (4, day(3), None)],
        "tweet_id int, date date, author string",
    )
    assert rows(influence.score(listed, posts, [])) == [(day(1), 10.0), (day(2), 0.0), (day(3), 0.0)]
    assert influence.posts_with_rank(listed, posts).count() == 4
    assert rows(social.by_authors(posts, listed), "tweet_id") == [(1,), (2,)]
    assert rows(influence.top(listed.dropna(), 1), "rank") == [(3.0,)]


def test_pages_with_missing_parts(spark, rows):
    pages_json = [
        '{"data":[{"id":"1","author_id":"u","referenced_tweets":[],"geo":null},'
        '{"id":"2","author_id":"v","in_reply_to_user_id":"u","geo":{"place_id":"p"},'
        '"referenced_tweets":[{"type":"quoted"},{"type":"replied_to"}]}],'
        '"includes":{"users":[{"id":"u","username":"U"},{"id":"u","username":"U"}]}}',
        '{"data":[{"id":"3"}],"includes":{"places":[{"id":"p","country":"C"}]}}',
    ]
    raw = spark.createDataFrame([(p,) for p in pages_json], ["value"])
    posts, users, places = pages.flatten(pages.parse(raw))
    assert rows(posts, "tweet_id", "tweet_type", "geo_id") == [
        ("1", None, None),
        ("2", "quoted", "p"),
        ("3", None, None),
    ]
    assert users.count() == 1
    full = social.enrich(posts, users, places)
    assert rows(full, "tweet_id", "username_source", "username_target", "country", "media") == [
        ("1", "U", None, None, "twitter"),
        ("2", None, "U", "C", "twitter"),
        ("3", None, None, None, "twitter"),
    ]


def test_search_is_by_word_language_and_second(spark, rows):
    at = dt.datetime
    data = [
        (1, "Bitcoin up", "en", at(2024, 1, 1)),
        (2, "bitcoin SCAM!", "en", at(2024, 1, 1)),
        (3, "bitcoin scammers", "en", at(2024, 1, 2, 23, 59, 59)),
        (4, "bitcoin", "id", at(2024, 1, 1)),
        (5, "bitcoin", "en", at(2024, 1, 3)),
    ]
    df = spark.createDataFrame(data, "id int, article string, lang string, ts timestamp_ntz")
    found = social.search(df, "bitcoin", ["scam"], "en", "2024-01-01", "2024-01-02")
    assert rows(found, "id") == [(1,), (3,)]


def test_outcomes(spark, rows):
    df = prices(spark, 1.0, 2.0, 2.0, 1.0).withColumn("prediction", F.lit("Up"))
    assert rows(ledger.score_next(df, KEY), "date", "outcome") == [
        (day(1), "Correct"),
        (day(2), "Wrong"),
        (day(3), "Wrong"),
        (day(4), ""),
    ]
    made = df.where(F.col("date") == day(2))
    scored = ledger.outcomes(prices(spark, 1.0, 2.0, 2.0, 1.0), made, KEY)
    assert rows(scored, "day", "price_diff", "outcome") == [
        (1, None, ""),
        (2, None, ""),
        (3, 0.0, "Wrong"),
        (4, -1.0, "Wrong"),
    ]


def test_short_last_run_counts_the_same(spark):
    data = [(1, day(1), i, 0.9 if i != 8 else 0.1, True) for i in range(9)]
    df = spark.createDataFrame(data, "k int, date date, id long, p double, actual boolean")
    got = evaluate.windowed_accuracy(df, ["k"], "id").first()
    assert (got["mean_acc"], got["std_acc"]) == (0.75, 0.25)


def test_macro_f1_over_classes_seen(spark):
    df = spark.createDataFrame([(True, True), (True, False)], "actual boolean, predicted boolean")
    assert evaluate.macro_f1(df).first()["macro_f1"] == pytest.approx((2 / 3 + 0) / 2)


def test_monthly_folds_stay_clamped(spark):
    got = folds.table(spark, dt.date(2024, 3, 31), dt.date(2024, 6, 30), 2, 1, freq="months")
    starts = [r["start_train"] for r in got.orderBy("fold_id").collect()]
    assert starts[:3] == [dt.date(2024, 1, 31), dt.date(2024, 2, 29), dt.date(2024, 3, 29)]


def test_days_resolve_to_wanted_fallback_or_nothing(spark, rows):
    df = spark.createDataFrame(
        [("a", day(5)), ("a", day(2)), ("b", day(2)), ("c", day(1)), ("c", day(9))],
        "series_id string, date date",
    )
    assert rows(daily.resolve_day(df, KEY, day(5), day(2))) == [("a", day(5)), ("b", day(2))]
    assert rows(daily.resolve_day(df, KEY, day(5))) == [("a", day(5))]
    assert rows(daily.resolve_day(df, KEY, day(5), latest=True)) == [
        ("a", day(5)),
        ("b", day(2)),
        ("c", day(1)),
    ]


def test_csv_keeps_newlines_quotes_nulls_and_empty_texts(spark, rows, tmp_path):
    data = [("t", 'a "b"\nc, d', day(1), "cnn"), (None, "", day(1), "cnn"), ("u", " x ", day(2), "cnn")]
    df = spark.createDataFrame(data, "title string, article string, date date, media string")
    path = f"{tmp_path}/csv"
    writers.write_daily(df, path, fmt="csv")
    stored = daily.read_day(spark, path, daily.ARTICLE_SCHEMA, day(1))
    assert rows(stored, "title", "article") == [("t", 'a "b"\nc, d'), (None, "")]
    with pytest.raises(daily.NoData):
        daily.read_day(spark, path, daily.ARTICLE_SCHEMA, day(7))


def test_csv_columns_go_by_name_and_titles_are_optional(spark, rows, tmp_path):
    path = f"{tmp_path}/untitled"
    df = spark.createDataFrame(
        [("twitter", "text", day(1))], "media string, article string, date date"
    )
    writers.write_daily(df, path, fmt="csv")
    stored = daily.read(spark, path, daily.ARTICLE_SCHEMA, day(1), day(1), "csv")
    assert rows(stored) == [(None, "text", day(1), "twitter")]
    assert "PartitionFilters: [isnotnull(date" in stored._jdf.queryExecution().toString()


def test_date_checks(spark):
    df = spark.createDataFrame([("2024-01-01",), ("x",), (None,)], ["said"])
    found = checks.dates(df, [], "said").first()
    assert (found["n"], found["n_missing"], found["n_invalid"]) == (3, 1, 1)
    with pytest.raises(checks.InvalidData):
        checks.require_dates(df, "said")
    assert checks.require_dates(df.limit(1), "said").count() == 1


def test_two_records_on_a_day_are_refused(spark):
    df = prices(spark, 1.0).unionByName(prices(spark, 2.0))
    with pytest.raises(checks.InvalidData):
        checks.require_daily_cardinality(df, calendar.days_between(df, KEY, day(1), day(2)), KEY)


def test_failed_publish_leaves_the_last_version(spark, tmp_path):
    root = f"{tmp_path}/pub"
    good = spark.createDataFrame([(1,)], ["x"])
    bad = good.select(F.raise_error(F.lit("broken")).alias("x"))
    writers.publish(spark, {"a": good, "b": good}, root, 1)
    with pytest.raises(Exception, match="broken"):
        writers.publish(spark, {"a": good.withColumn("x", F.lit(2)), "b": bad}, root, 2)
    stored = writers.published(spark, root)
    assert [stored[n].first()["x"] for n in ("a", "b")] == [1, 1]


def test_batches_kept_apart_and_stored_days_skipped(spark, rows, tmp_path):
    path = f"{tmp_path}/batches"
    df = prices(spark, 1.0, 2.0)
    writers.write_daily(df, path, batch="first")
    writers.write_daily(df, path, batch="second")
    assert spark.read.parquet(path).groupBy("batch").count().count() == 2
    assert rows(writers.skip_stored_days(df, prices(spark, 9.0)), "date") == [(day(2),)]


def test_page_parsing_takes_any_legal_html(spark):
    html = "<H1 class='x'>Up&#8217;s &#x1F680;</H1><P>One &#38; two</P><p>three&mdash;</p>"
    page = spark.createDataFrame([(html,)], "html string")
    got = page.select(text.page_headline(F.col("html")), text.page_paragraphs(F.col("html"))).first()
    assert tuple(got) == ("Up\u2019s \U0001f680", "One & two\nthree&mdash;")


def test_folds_in_hours_and_their_default_start(spark):
    rows = [(dt.datetime(2024, 1, 1, h),) for h in range(10)]
    df = spark.createDataFrame(rows, "date timestamp_ntz")
    start = folds.default_start(df, 4, "hours")
    assert start == dt.datetime(2024, 1, 1, 4)
    got = folds.assign(df, start, dt.datetime(2024, 1, 1, 9), train=4, test=3, freq="hours").collect()
    hours = {(f, r): sorted(x["date"].hour for x in got if (x["fold_id"], x["role"]) == (f, r)) for f in (0, 1) for r in ("train", "test")}
    assert hours == {(0, "train"): [0, 1, 2, 3], (0, "test"): [4, 5, 6], (1, "train"): [3, 4, 5, 6], (1, "test"): [7, 8, 9]}
    assert folds.default_start(spark.createDataFrame([(day(31),)], "date date"), 1, "months") == dt.date(2024, 2, 29)
