"""Streams over several batches and restarts end where one batch would."""

from pyspark.sql import functions as F

from tests.conftest import day
from tidecast import fixtures as fx
from tidecast.streaming import arrivals

SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string"


def drops(spark, sf_dir, path, first, last):
    """One delivery: the events of some days, one file per day."""
    events = fx.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    part = events.where(F.to_date("ts").between(day(first), day(last)))
    part.repartition(3).write.mode("append").parquet(path)
    return part


def test_ingest_in_batches_with_redelivery_and_restart(spark, sf_dir, rows, tmp_path):
    source, path, checkpoint = (f"{tmp_path}/{n}" for n in ("drops", "table", "state"))
    drops(spark, sf_dir, source, 1, 5)
    arrivals.ingest(arrivals.arrivals(spark, source, SCHEMA, files_per_batch=1), "event_id", path, checkpoint)
    drops(spark, sf_dir, source, 4, 9)
    arrivals.ingest(arrivals.arrivals(spark, source, SCHEMA, files_per_batch=2), "event_id", path, checkpoint)
    arrivals.ingest(arrivals.arrivals(spark, source, SCHEMA), "event_id", path, checkpoint)
    events = fx.table(spark, sf_dir, "events")
    expected = events.where(F.to_date("ts").between(day(1), day(9)))
    assert rows(spark.read.parquet(path), "event_id") == rows(expected, "event_id")


def test_a_fresh_checkpoint_stores_nothing_twice(spark, sf_dir, rows, tmp_path):
    source, path = f"{tmp_path}/drops", f"{tmp_path}/table"
    drops(spark, sf_dir, source, 1, 5)
    for state in ("first", "second"):
        stream = arrivals.arrivals(spark, source, SCHEMA, files_per_batch=1)
        arrivals.ingest(stream, "event_id", path, f"{tmp_path}/{state}")
    expected = fx.table(spark, sf_dir, "events").where(F.to_date("ts").between(day(1), day(5)))
    assert rows(spark.read.parquet(path), "event_id") == rows(expected, "event_id")


def test_late_rows_update_the_counts(spark, sf_dir, rows, tmp_path):
    source, path, checkpoint = (f"{tmp_path}/{n}" for n in ("drops", "table", "state"))
    for first, last in ((1, 3), (3, 4), (4, 6)):
        drops(spark, sf_dir, source, first, last)
        stream = arrivals.arrivals(spark, source, SCHEMA)
        arrivals.daily_counts(stream, ["event_type"], "event_id", path, checkpoint)
    got = spark.read.parquet(f"{path}/counts").select("date", "event_type", "n")
    delivered = spark.read.schema(SCHEMA).parquet(source).dropDuplicates(["event_id"])
    expected = delivered.groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count("*").alias("n"))
    assert rows(got) == rows(expected)


def test_repeats_across_batches_are_dropped(spark, sf_dir, rows, tmp_path):
    source, path, checkpoint = (f"{tmp_path}/{n}" for n in ("drops", "table", "state"))
    for first, last in ((1, 3), (2, 4)):
        drops(spark, sf_dir, source, first, last)
        arrivals.dedup(arrivals.arrivals(spark, source, SCHEMA), "event_id", path, checkpoint, "5 days")
    events = fx.table(spark, sf_dir, "events")
    expected = events.where(F.to_date("ts").between(day(1), day(4)))
    assert rows(spark.read.parquet(path), "event_id") == rows(expected, "event_id")
