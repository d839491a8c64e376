"""Merges into stored days, and versions against rival writers."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tidecast.sources import merge, versions, writers
from tidecast.sources.versions import Change

SCHEMA = "series_id string, value double, date date"
ON = ["series_id", "date"]


def frame(spark, *rows):
    return spark.createDataFrame([(s, float(v), d) for s, v, d in rows], SCHEMA)


def files_of(path):
    return {os.path.join(b, f): os.stat(os.path.join(b, f)).st_mtime_ns for b, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/table"
    merge.upsert_days(frame(spark, *[(s, n, day(n)) for s in "ab" for n in range(1, 6)]), path, ON)
    return path


def stored(spark, path):
    return {(r["series_id"], r["date"]): r["value"] for r in spark.read.schema(SCHEMA).parquet(path).collect()}


def test_only_the_days_of_the_batch_are_read_and_replaced(spark, table):
    before, files = stored(spark, table), files_of(table)
    batch = frame(spark, ("a", 30, day(3)), ("c", 31, day(3)), ("a", 90, day(9)))
    assert merge.upsert_days(batch, table, ON) == [day(3), day(9)]
    assert stored(spark, table) == before | {("a", day(3)): 30.0, ("c", day(3)): 31.0, ("a", day(9)): 90.0}
    after = files_of(table)
    assert {f: t for f, t in after.items() if "date=2024-01-03" not in f and "date=2024-01-09" not in f} == {
        f: t for f, t in files.items() if "date=2024-01-03" not in f
    }
    pruned = merge.stored_days(spark, table, batch.schema, [day(3)])
    assert re.search(r"PartitionFilters: \[[^\]]*date#", pruned._jdf.queryExecution().executedPlan().toString())
    read = pruned.select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("date=2024-01-03" in r["f"] for r in read)


def test_inserts_leave_stored_rows_alone(spark, table):
    before = stored(spark, table)
    for _ in range(2):
        merge.insert_days(frame(spark, ("a", 30, day(3)), ("c", 31, day(3))), table, ON)
    assert stored(spark, table) == before | {("c", day(3)): 31.0}
    assert merge.upsert_days(frame(spark), table, ON) == []
    with pytest.raises(ValueError):
        merge.upsert_days(frame(spark, ("a", 1, None)), table, ON)
    with pytest.raises(ValueError):
        merge.upsert_days(frame(spark, ("a", 1, day(1))), table, ["series_id"])


@pytest.mark.parametrize("lost", [False, True])
def test_a_merge_that_was_stopped_is_ended_by_the_next(spark, table, monkeypatch, lost):
    before, real = stored(spark, table), merge._replace_days

    def stopped(spark, journal, path, schema):
        if lost:  # stopped between dropping the old files of a day and moving the new ones there
            for name in files_of(path):
                if "date=2024-01-03" in name and "_merge" not in name:
                    os.remove(name)
        raise KeyboardInterrupt

    monkeypatch.setattr(merge, "_replace_days", stopped)
    with pytest.raises(KeyboardInterrupt):
        merge.upsert_days(frame(spark, ("a", 30, day(3))), table, ON)
    monkeypatch.setattr(merge, "_replace_days", real)
    merge.upsert_days(frame(spark, ("b", 40, day(4))), table, ON)
    assert stored(spark, table) == before | {("a", day(3)): 30.0, ("b", day(4)): 40.0}
    os.makedirs(f"{table}/_merge/000000-half/rows")
    assert merge.recover(spark, table, frame(spark).schema) == 0 and not os.listdir(f"{table}/_merge")


def test_of_two_writers_of_one_version_one_fails(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    base = versions.load(spark, root)
    assert base.number == 0 and versions.tables(spark, root, base) == {}
    first = versions.commit(spark, root, {"t": Change(frame(spark, ("a", 1, day(1))))}, base)
    with pytest.raises(versions.VersionTaken):
        versions.commit(spark, root, {"t": Change(frame(spark, ("b", 2, day(1))))}, base)
    assert [r["series_id"] for r in versions.tables(spark, root, versions.load(spark, root))["t"].collect()] == ["a"]
    with pytest.raises(ValueError):
        versions.commit(spark, root, {"t": Change(spark.range(2), append=True)}, first)


def test_a_rival_between_check_and_create_fails_too(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/ledger"
    versions.commit(spark, root, {"t": Change(frame(spark, ("a", 1, day(1))))})
    monkeypatch.setattr(versions, "numbers", lambda *_: [])
    with pytest.raises(versions.VersionTaken):
        versions.commit(spark, root, {"t": Change(frame(spark, ("b", 2, day(1))))}, versions.Version(0))


def test_a_ledger_grows_by_its_new_rows_and_old_versions_go(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    for n in range(1, 6):
        found = versions.commit(spark, root, {"log": Change(frame(spark, ("a", n, day(n))), append=True), "now": Change(frame(spark, ("a", n, day(n))))})
        assert found.number == n and len(found.folders["log"]) == n and len(found.folders["now"]) == 1
    now = versions.load(spark, root)
    assert len(os.listdir(f"{root}/log")) == 5 == versions.tables(spark, root, now)["log"].count()
    gone = versions.expire(spark, root, keep=2)
    assert len(gone) == 3 and all(p.startswith("now/") for p in gone)
    assert versions.numbers(spark, root) == [4, 5]
    assert versions.tables(spark, root, versions.load(spark, root, 4))["now"].first()["value"] == 4
    assert versions.tables(spark, root, versions.load(spark, root))["log"].agg(F.sum("value")).first()[0] == 15
    with pytest.raises(LookupError):
        versions.load(spark, root, 3)


def test_a_version_cut_off_while_it_was_written_does_not_count(spark, tmp_path):
    root = f"{tmp_path}/ledger"
    versions.commit(spark, root, {"t": Change(frame(spark, ("a", 1, day(1))))})
    with open(f"{root}/_versions/000000000002.json", "w") as half:
        half.write('{"folders": {"t"')
    assert versions.load(spark, root).number == 1
    assert versions.commit(spark, root, {"t": Change(frame(spark, ("a", 3, day(1))))}).number == 3
    assert versions.load(spark, root).number == 3


def test_the_whole_table_rules_agree_with_the_merge_by_days(spark, table, rows):
    batch = frame(spark, ("a", 30, day(3)), ("z", 5, day(20)))
    whole = rows(writers.upsert(batch, spark.read.schema(SCHEMA).parquet(table), ON), "series_id", "date", "value")
    merge.upsert_days(batch, table, ON)
    assert rows(spark.read.schema(SCHEMA).parquet(table), "series_id", "date", "value") == whole


def test_days_run_one_after_another_and_again(spark, tmp_path):
    from tidecast.operators import ledger
    from tidecast.plans import daily_job

    keys, root = ["series_id"], f"{tmp_path}/ledger"
    totals = spark.createDataFrame([("a", day(n), n, 1) for n in range(1, 8)], "series_id string, date date, total_positive long, total_negative long")
    trends = spark.createDataFrame([("a", day(n), 2.5 * n) for n in range(1, 8)], "series_id string, date date, trends double")
    metrics = spark.createDataFrame([("a", 0.5)], "series_id string, eval_acc double")

    def record(n, price, p):
        schema = "series_id string, date date, close_price double, p double, positive long, negative long, news_sentiment double, trends double"
        rows = spark.createDataFrame([("a", day(n), price, p, n, 1, 0.25, 2.5 * n)], schema)
        return ledger.record(rows, metrics, keys, ["trends"])

    run = lambda n, price, p: daily_job.publish_day(record(n, price, p), totals, trends, keys, root)
    # A record is dated a day after the price, and is about the day after that.
    assert run(3, 10.0, 0.9).number == 1
    tables = versions.tables(spark, root, versions.load(spark, root))
    assert tables["results"].count() == 0 and tables["records"].count() == 1
    assert tables["current"].first()["target_date"] == "05/01/2024"
    run(4, 12.0, 0.2)
    run(5, 15.0, 0.7)
    last = run(5, 15.0, 0.7)
    assert last.number == 4
    tables = versions.tables(spark, root, last)
    got = [(r["datetime"], r["price"], r["price_diff"], r["outcome"]) for r in tables["results"].orderBy("datetime").collect()]
    assert got == [("2024-01-05 07:00:00", 12.0, 2.0, "Correct"), ("2024-01-06 07:00:00", 15.0, 3.0, "Wrong")]
    assert [r["utc_date"] for r in tables["records"].orderBy("utc_date").collect()] == [day(3), day(4), day(5)]
    assert [(r["target_date"], r["prediction"]) for r in tables["current"].collect()] == [("07/01/2024", "Up")]
    assert sum(len(p) for n, p in last.folders.items() if n in ("results", "records")) == 8
