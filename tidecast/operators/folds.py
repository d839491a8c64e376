"""Time-ordered hold-outs and rolling cross-validation folds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_DAYS = {"days": 1, "weeks": 7}
_MONTHS = {"months": 1, "years": 12}
_SECONDS = {"hours": 3600, "minutes": 60, "seconds": 1}


def _later(moment: Column, n: int, freq: str) -> Column:
    if freq in _DAYS:
        return F.date_add(moment, n * _DAYS[freq])
    if freq in _MONTHS:
        return F.add_months(moment, n * _MONTHS[freq])
    if freq in _SECONDS:
        return moment.cast("timestamp_ntz") + F.make_dt_interval(secs=F.lit(n * _SECONDS[freq]))
    raise ValueError(f"unknown unit {freq!r}, use one of {[*_DAYS, *_MONTHS, *_SECONDS]}")


def default_start(df: DataFrame, train: int, freq: str = "days") -> dt.date | dt.datetime:
    """The first test date if none is given: one training period after the first date."""
    return df.agg(_later(F.min("date"), train, freq)).first()[0]


def table(
    spark: SparkSession,
    first_test: dt.date | dt.datetime,
    last: dt.date | dt.datetime,
    train: int,
    test: int,
    gap: int = 0,
    freq: str = "days",
) -> DataFrame:
    """Rolling folds: ``(fold_id, start_train, end_train, start_test, end_test)``.

    Ends are exclusive. Both windows move by ``test`` units; the last fold is the last
    one that starts on or before ``last``. Months are added step by step, so a start on
    the 31st stays clamped once a short month has clamped it. Hours, minutes and seconds
    give timestamps, the other units dates.
    """
    start = _later(F.lit(first_test), -train, freq)
    if freq in _SECONDS:
        limit = int((last - first_test).total_seconds()) // (test * _SECONDS[freq]) + 2
    else:
        limit = (last - first_test).days // (test * _DAYS.get(freq, 28)) + 2
    step_starts = F.aggregate(
        F.sequence(F.lit(1), F.lit(limit)),
        F.array(start),
        lambda done, _: F.concat(done, F.array(_later(F.element_at(done, -1), test, freq))),
    )
    folds = (
        spark.range(1)
        .select(F.posexplode(step_starts).alias("fold_id", "start_train"))
        .withColumn("end_train", _later(F.col("start_train"), train, freq))
        .withColumn("start_test", _later(F.col("end_train"), gap, freq))
        .withColumn("end_test", _later(F.col("start_test"), test, freq))
    )
    return folds.where(F.col("start_test") <= F.lit(last))


def assign(
    df: DataFrame,
    first_test: dt.date | dt.datetime,
    last: dt.date | dt.datetime,
    train: int,
    test: int,
    gap: int = 0,
    freq: str = "days",
) -> DataFrame:
    """Label rows with their folds: one output row per (row, fold, role).

    In days, fold k trains on ``[s + k*test, s + k*test + train)``, so the folds of a row
    follow from its date by division. In other units the fold list, which the calendar
    bounds, is held against each date. The rows are exploded in place: no join, no shuffle.
    """
    if freq != "days":
        return _assign_listed(df, table(df.sparkSession, first_test, last, train, test, gap, freq))
    start = first_test - dt.timedelta(train)
    test_start = first_test + dt.timedelta(gap)
    n_folds = (last - test_start).days // test + 1 if last >= test_start else 0
    age = F.date_diff(F.col("date"), F.lit(start))
    test_age = F.date_diff(F.col("date"), F.lit(test_start))
    low = F.greatest(F.floor((age - train) / test) + 1, F.lit(0))
    high = F.least(F.floor(age / test), F.lit(n_folds - 1))
    tested = F.floor(test_age / test)
    train_folds = F.when(low <= high, F.sequence(low, high))
    test_folds = F.when((tested >= 0) & (tested < n_folds), F.array(tested))
    none = F.expr("cast(array() as array<bigint>)")

    def labelled(ids: Column, role: str) -> Column:
        name = F.lit(role).alias("role")
        return F.transform(F.coalesce(ids, none), lambda k: F.struct(k.alias("fold_id"), name))

    pairs = F.concat(labelled(train_folds, "train"), labelled(test_folds, "test"))
    return df.select(*df.columns, F.inline(pairs))


def _assign_listed(df: DataFrame, listed: DataFrame) -> DataFrame:
    bounds = listed.orderBy("fold_id").collect()
    if not bounds:
        return df.select(*df.columns, F.lit(0).cast("long").alias("fold_id"), F.lit("train").alias("role")).limit(0)
    every = F.array(
        *[
            F.struct(
                F.lit(int(b["fold_id"])).cast("long").alias("fold_id"),
                F.lit(role).alias("role"),
                F.lit(b[f"start_{role}"]).alias("start"),
                F.lit(b[f"end_{role}"]).alias("end"),
            )
            for b in bounds
            for role in ("train", "test")
        ]
    )
    own = F.filter(every, lambda f: (f["start"] <= F.col("date")) & (F.col("date") < f["end"]))
    return df.select(*df.columns, F.inline(F.transform(own, lambda f: F.struct(f["fold_id"], f["role"]))))


def date_bounds(df: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last date: two values on the driver, to lay out the fold list."""
    row = df.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    return row["first"], row["last"]


def holdout(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Add ``role``: each series' last ``n`` days are ``test``, the rest ``train``.

    The window holds one row per day of a series, so the calendar bounds it.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("date"))
    is_test = F.row_number().over(newest_first) <= n
    return df.withColumn("role", F.when(is_test, "test").otherwise("train"))


def split_dates(df: DataFrame, keys: list[str], train: int, n: int) -> DataFrame:
    """Date of the row after the first ``train`` rows, and of the ``n``-th row from the end.

    The set of days of a series is bounded by the calendar and combined before the
    shuffle. A series that is too short gives NULL.
    """
    days = F.sort_array(F.collect_set("date"))
    return (
        df.groupBy(*keys)
        .agg(days.alias("_days"))
        .select(
            *keys,
            F.try_element_at("_days", F.lit(train + 1)).alias("tuning_start"),
            F.try_element_at("_days", F.lit(-n)).alias("holdout_start"),
        )
    )
