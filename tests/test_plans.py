"""What the physical plans must and must not contain."""

import datetime as dt
import re

import pytest

from tidecast import fixtures as fx
from tidecast.plans import catalog
from tidecast.sources import daily, writers

LAZY = [
    "feature_table",
    "aspect_polarity_count",
    "daily_close",
    "influence_score",
    "sample_n_per_day",
    "lexicon_polarity",
    "normalize_text",
    "page_article",
    "encode_fixed_length",
    "rolling_folds",
    "windowed_accuracy",
    "asof_last_prediction",
    "check_duplicate_text",
    "enrich_reply_target",
    "relative_time",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_window_over_everything(name, spark, sf_dir):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    if name != "encode_fixed_length":  # numbers the limited vocabulary
        for window in re.findall(r"\bWindow \[.*", text):
            assert "windowspecdefinition(" in window
            assert not re.search(r"windowspecdefinition\([^,]*(ASC|DESC)", window), window


def test_outer_join_of_all_sources_is_one_shuffle_over_aggregates(spark, sf_dir):
    text = plan(catalog.feature_table(spark, sf_dir))
    assert "FullOuter" not in text and "SortAggregate" not in text
    assert len(re.findall(r"\bUnion\b", text)) == 1


def test_raw_scans_read_only_needed_columns(spark, sf_dir):
    text = plan(catalog.daily_close(spark, sf_dir))
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>", text)
    assert "props" not in text


def test_filters_reach_the_scan(spark, sf_dir):
    text = plan(catalog.keyword_search(spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*EqualTo\(lang,en\)", text)


def test_sample_is_trimmed_before_both_shuffles(spark, sf_dir):
    text = plan(catalog.sample_n_per_day(spark, sf_dir))
    assert len(re.findall(r"WindowGroupLimit", text)) == 4


def test_dated_scans_prune_partitions(spark, sf_dir, tmp_path):
    path = f"{tmp_path}/close"
    writers.write_daily(fx.close(spark, sf_dir), path, fmt="json")
    df = daily.read(
        spark,
        path,
        "series_id string, close_price double, date date",
        dt.date(2024, 1, 3),
        dt.date(2024, 1, 5),
    )
    assert re.search(r"PartitionFilters: \[.*date#", plan(df))
    assert len(df.inputFiles()) > 3 and df.select("date").distinct().count() == 3


def test_a_large_lookup_is_not_broadcast(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(catalog.influence_join(spark, sf_dir))
        assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
