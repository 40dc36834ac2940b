"""Property tests: helpers against plain-Python definitions (hypothesis)."""

import datetime as dt
import hashlib
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from martforge.functions import day_diff, hour_diff, round_half_up, surrogate_key
from martforge.functions.keys import KEY_NULL_TOKEN

TS = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31)).map(
    lambda d: d.replace(microsecond=0))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(TS, TS), min_size=1, max_size=40))
def test_boundary_differences(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = df.select("a", "b", day_diff("a", "b").alias("d"), hour_diff("a", "b").alias("h")).collect()
    for r in got:
        assert r.d == (r.b.date() - r.a.date()).days
        hours = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(hours=1)
        assert r.h == hours(r.b) - hours(r.a)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=40))
def test_round_half_up_matches_decimal_text(spark, ints):
    vals = [i / 1000 for i in ints]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double").select(round_half_up("x", 2))
           .collect()]
    want = [float(Decimal(repr(v)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in vals]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.one_of(st.none(), st.text(max_size=8))), min_size=1,
                max_size=20))
def test_surrogate_key_is_md5_of_dash_joined_parts(spark, rows):
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(surrogate_key("a", "b")).collect()]
    want = [hashlib.md5((a + "-" + (b if b is not None else KEY_NULL_TOKEN)).encode()).hexdigest()
            for a, b in rows]
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abcde")),
                          st.one_of(st.none(), st.sampled_from(["x", "y", "z", "q"]))), max_size=30),
       st.lists(st.one_of(st.none(), st.sampled_from("abc")), max_size=10))
def test_check_suite_matches_brute_force(spark, rows, parents):
    from martforge.operators.checks import Check, run_suite

    child = spark.createDataFrame(rows, "k string, v string")
    parent = spark.createDataFrame([(p,) for p in parents], "k string")
    checks = [Check("t", "k", "not_null"), Check("t", "k", "unique"), Check("t", "v", "accepted_values", ("x", "y")),
              Check("t", "k", "relationships", (), "p", "k")]
    got = {r.check_name: r.failures for r in run_suite({"t": child, "p": parent}, checks).collect()}
    keys = [k for k, _ in rows]
    present = {k for k in keys if k is not None}
    want = {
        "not_null_t_k": sum(k is None for k in keys),
        "unique_t_k": sum(1 for k in present if keys.count(k) > 1),
        "accepted_values_t_v": len({v for _, v in rows if v is not None and v not in ("x", "y")}),
        "relationships_t_k__p_k": sum(1 for k in keys if k is not None and k not in set(parents)),
    }
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3"]), st.one_of(st.none(), st.sampled_from("abcd"))),
                min_size=1, max_size=40))
def test_modes_match_brute_force(spark, rows):
    from collections import Counter

    from pyspark.sql import functions as F

    from martforge.operators import modes_per_key

    got = {r.k: r.m for r in modes_per_key(spark.createDataFrame(rows, "k string, v string"), "k",
                                           {"m": F.col("v")}).collect()}
    want = {}
    for k in {k for k, _ in rows}:
        counts = Counter(v for kk, v in rows if kk == k and v is not None)
        want[k] = min(counts, key=lambda v: (-counts[v], v)) if counts else None
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 1000)), min_size=1, max_size=30, unique_by=lambda r: r[2]))
def test_latest_and_arg_max_match_brute_force(spark, rows):
    from pyspark.sql import functions as F

    from martforge.operators import arg_max, latest_per_key

    df = spark.createDataFrame(rows, "k string, t int, id int")
    latest = {r.k: r.id for r in latest_per_key(df, ["k"], [F.col("t").desc_nulls_first(), F.col("id").desc()])
              .collect()}
    top = {r.k: r.v for r in df.groupBy("k").agg(arg_max("id", ["t", "id"]).alias("v")).collect()}
    for k in {k for k, _, _ in rows}:
        group = [(t, i) for kk, t, i in rows if kk == k]
        nulls = [i for t, i in group if t is None]
        want_latest = max(nulls) if nulls else max(group)[1]
        assert latest[k] == want_latest
        ordered = [(t, i) for t, i in group if t is not None]
        assert top[k] == (max(ordered)[1] if ordered else None)
