"""Windows over a whole series without a single task: the same values as the one-task windows."""

import random

import pytest
from pyspark.sql import functions as F

from martforge.operators.windows import rolling_rows_avg, running_total, with_rolling_rows_avg, with_running_total
from tools.plan_text import plan_text


def _same(a, b, columns):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in a.select(*columns).collect()), key=key) == sorted((tuple(r) for r in b.select(*columns).collect()), key=key)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice([None, *range(200)]), rng.choice([None, 0.0, 0.125, -3.25, 99999.99])) for k in range(1500)]
    rows += [(2000 + k, 77, 1.0) for k in range(700)]  # a hot value
    return spark.createDataFrame([(*r, 1) for r in rows], "id long, day int, v double, n int").repartition(6).cache()


@pytest.mark.parametrize("ranges", [1, 7, 400])
def test_running_total(spark, series, ranges):
    want = series.withColumn("t", running_total("v", "day"))
    got = with_running_total(series, "v", "day", "t", ranges)
    assert got.columns == [*series.columns, "t"]
    _same(got, want, ["id", "day", "v", "t"])


@pytest.mark.parametrize("ranges, rows", [(1, 7), (2, 50), (7, 7), (60, 2), (400, 50), (400, 1)])
def test_rolling_average(spark, series, ranges, rows):
    unique = series.withColumn("k", F.coalesce(F.col("day"), F.lit(10**6)).cast("long") * 10_000 + F.col("id"))
    want = unique.withColumn("a", rolling_rows_avg("v", "k", rows, digits=None))
    got = with_rolling_rows_avg(series, "v", ["day", "id"], rows, "a", None, ranges)
    _same(got, want, ["id", "day", "v", "a"])


def test_small_and_odd_series(spark):
    for rows in ([], [(1, None, None)], [(1, 5, None), (2, 6, 2.0)], [(1, None, 3.0), (2, None, 4.0)]):
        df = spark.createDataFrame(rows, "id long, day int, v double")
        _same(with_running_total(df, "v", "day", "t", 3), df.withColumn("t", running_total("v", "day")), ["id", "t"])
        got = with_rolling_rows_avg(df, "v", ["day", "id"], 3, "a", 2, 3)
        assert got.count() == len(rows)


def test_no_window_of_rows_without_a_partition_key(spark, series):
    """Only the one row a range meets in one task."""
    for frame in (with_running_total(series, "v", "day", "t", 7), with_rolling_rows_avg(series, "v", ["day", "id"], 7, "a", 2, 7)):
        plan = plan_text(frame)
        windows = [line for line in plan.splitlines() if "SinglePartition" in line]
        assert all("plan_id" in line for line in windows)
        assert plan.count("SinglePartition") <= 3  # the totals of the ranges


def test_dates_and_timestamps_order_a_series(spark):
    df = spark.range(500).select("id", F.date_add(F.lit("2018-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"),
                                 F.timestamp_add("MINUTE", F.col("id") * 7 % 977, F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")).alias("t"),
                                 (F.col("id") % 13).cast("double").alias("v"))
    for c in ("d", "t"):
        _same(with_running_total(df, "v", c, "x", 9), df.withColumn("x", running_total("v", c)), ["id", "x"])
