"""Time the queries on the generated tables; print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. The
result is forced with the ``noop`` sink, so every column of every row is computed.
``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_RUNS`` set the data, the cores and the runs;
``BENCH_ALL=1`` times every query so; otherwise some fits, streams and writes run once after
the headline queries and are reported beside them. ``random_search`` is 4 trials x 2 folds x
4 to 8 trees of depth 2 to 6, ``evaluate_model`` 20 trials x 7 folds x 350 to 1000 trees and 7 hold-out folds,
``network_relevance`` 12 steps over the labelled texts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from tidecast.plans import catalog
from tidecast.session import local_session

HEADLINE = [
    "feature_table",
    "calendar_fill",
    "daily_close",
    "log_return",
    "up_label",
    "metric_pivot",
    "aspect_polarity_count",
    "polarity_score",
    "sample_n_per_day",
    "aspect_expand",
    "lexicon_polarity",
    "influence_score",
    "top_influencers",
    "posts_by_influencers",
    "flatten_pages",
    "enrich_author",
    "enrich_reply_target",
    "keyword_search",
    "dedup_rows",
    "dedup_first",
    "normalize_text",
    "page_article",
    "relative_time",
    "build_vocab",
    "encode_fixed_length",
    "rolling_folds",
    "macro_f1",
    "windowed_accuracy",
    "asof_last_prediction",
    "ledger_append",
    "prediction_record",
    "check_duplicate_text",
    "check_daily_cardinality",
    "batch_infer",
]


#: Fits, streams and writes: timed once each, outside the total.
OTHERS = [
    "random_search",
    "evaluate_model",
    "network_relevance",
    "asof_events",
    "upsert_stored_days",
    "stream_ingest",
    "stream_daily_counts",
    "write_by_date",
]


def _force(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(catalog.QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    names = sys.argv[1:] or names
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        _force(spark, name, sf_dir)
        timings[name] = round(statistics.median(_force(spark, name, sf_dir) for _ in range(runs)), 3)
    others = [] if sys.argv[1:] or names != HEADLINE else OTHERS
    others = {name: round(_force(spark, name, sf_dir), 3) for name in others}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "others": others,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
