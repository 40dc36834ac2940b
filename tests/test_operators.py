"""Generic operators on hand-made rows (FIXTURES §4)."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.operators import (
    arg_max, conditional_counts, latest_per_key, mode_per_key, modes_per_key, period_to_date_sum,
    rolling_rows_avg, running_total,
)


def test_latest_per_key_null_time_wins_then_larger_id(spark):
    rows = [("o1", "r1", None), ("o1", "r2", dt.datetime(2018, 1, 2)), ("o1", "r3", dt.datetime(2018, 1, 3)),
            ("o2", "r1", dt.datetime(2018, 1, 3)), ("o2", "r9", dt.datetime(2018, 1, 3))]
    df = spark.createDataFrame(rows, "k string, rid string, t timestamp_ntz")
    got = latest_per_key(df, ["k"], [F.col("t").desc_nulls_first(), F.col("rid").desc()])
    assert sorted((r.k, r.rid) for r in got.collect()) == [("o1", "r1"), ("o2", "r9")]


def test_latest_per_key_plans_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    from tools.plan_text import plan_text

    plan = plan_text(latest_per_key(df, ["k"], [F.col("v").desc()]))
    assert "WindowGroupLimit" in plan


def test_arg_max_text_order_and_nulls(spark):
    rows = [("o1", "9", "boleto"), ("o1", "10", "voucher"), ("o2", None, "x"), ("o3", "1", None),
            ("o3", None, "y")]
    df = spark.createDataFrame(rows, "k string, seq string, v string")
    got = {r.k: (r.t, r.n) for r in df.groupBy("k").agg(
        arg_max("v", ["seq", "v"]).alias("t"), arg_max("v", ["seq", "v"], numeric_order=True).alias("n")).collect()}
    assert got["o1"] == ("boleto", "voucher")
    assert got["o2"] == (None, None)  # no ordered row
    assert got["o3"] == (None, None)  # the latest row's value is NULL
    odd = spark.createDataFrame([("o", "x", "a"), ("o", "2", "b")], "k string, seq string, v string")
    assert odd.groupBy("k").agg(arg_max("v", ["seq", "v"], numeric_order=True)).first()[1] == "b"


def test_mode_ties_and_nulls(spark):
    rows = [("z", v) for v in ["b", "a", "a", "b", None, None, None]] + [("y", None)]
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r.k: r.m for r in mode_per_key(df, "k", "v", "m").collect()}
    assert got == {"z": "a", "y": None}  # a key with only NULL values has a NULL mode


def test_modes_and_measures_in_one_pass(spark):
    rows = [("z", "b", "X", 1.0), ("z", "a", "Y", 2.0), ("z", "a", "Y", None), (None, "q", None, 4.0)]
    df = spark.createDataFrame(rows, "k string, c string, s string, x double")
    out = modes_per_key(df, "k", {"c": F.col("c"), "s": F.col("s")}, {"x": F.col("x").cast("decimal(10,2)")})
    got = {r.k: (r.c, r.s, float(r.x_sum) if r.x_sum is not None else None, r.x_count) for r in out.collect()}
    assert got == {"z": ("a", "Y", 3.0, 2), None: ("q", None, 4.0, 1)}


def test_conditional_counts_skip_null_predicates(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "t string")
    r = df.agg(*conditional_counts({"a": F.col("t") == "a", "b": F.col("t") == "b"})).first()
    assert (r.a, r.b) == (2, 1)


def test_rolling_rows_span_gaps_and_month_restart(spark):
    days = [(dt.date(2018, 1, 1), 10.0), (dt.date(2018, 1, 2), 20.0), (dt.date(2018, 1, 9), 30.0),
            (dt.date(2018, 1, 31), 40.0), (dt.date(2018, 2, 1), 50.0), (None, 5.0)]
    df = spark.createDataFrame(days, "d date, x double")
    out = df.select("d", rolling_rows_avg("x", "d", 3).alias("r3"), period_to_date_sum("x", "d").alias("mtd"),
                    running_total("x", "d").alias("cum"))
    got = {r.d: (r.r3, r.mtd, r.cum) for r in out.collect()}
    assert got[dt.date(2018, 1, 9)] == (20.0, 60.0, 60.0)  # 3 rows, days 1, 2, 9
    assert got[dt.date(2018, 2, 1)] == (40.0, 50.0, 150.0)  # month restarts
    assert got[None] == (31.67, 5.0, 155.0)  # NULL day sorts last


def test_fractions_of_a_cent_add_up(spark):
    from martforge.functions import avg_money, sum_money

    df = spark.createDataFrame([(dt.date(2018, 1, i), 0.004) for i in (1, 2, 3)], "d date, x double")
    assert tuple(df.agg(sum_money("x"), avg_money("x")).first()) == (0.012, 0.004)
    out = df.select("d", rolling_rows_avg("x", "d", 3, digits=None).alias("r3"), period_to_date_sum("x", "d").alias("mtd"),
                    running_total("x", "d").alias("cum")).orderBy("d").collect()[-1]
    assert (out.r3, out.mtd, out.cum) == (0.004, 0.012, 0.012)
