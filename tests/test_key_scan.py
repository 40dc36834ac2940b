"""The pre-pass of key checks: no failing key is cleared, and few others are left."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martforge.operators import checks, key_filter, key_scan
from martforge.operators.checks import Suite, run_suite


@pytest.mark.parametrize("n", [1, 2, 3000])
def test_packed_fingerprints_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (2**8, 2**40, 2**64):
        values = np.unique(rng.integers(0, high, n, dtype=np.uint64, endpoint=False) if high < 2**64 else rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        assert (key_scan._unpack(*key_scan._pack(values)) == values).all()


def test_buckets_rise_with_the_fingerprint():
    values = np.sort(np.random.default_rng(0).integers(0, 2**63, 1000, dtype=np.uint64))
    at = key_scan._buckets(values, 64, 7)
    assert (np.diff(at.astype(int)) >= 0).all() and set(at.tolist()) <= set(range(7))


def test_colliding_hashes_need_equal_tags():
    """Children of a parent's hash but another tag are suspects; equal pairs are cleared."""
    send = key_scan._send([key_scan.KeyRole(9, "c", "child")], 1)
    batch = lambda h, t: pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(t, pa.int32())], names=["h0", "t0"])
    up = lambda values: [v and v << 8 for v in values]  # noqa: E731  a fingerprint is the hash's high bits
    child = list(send(iter([batch(up([5, 5, 7, None, -3]), [1, 2, 1, None, 4])])))
    parent = list(key_scan._send([key_scan.KeyRole(9, "p", "parent")], 1)(iter([batch(up([5, 7, 7, -3]), [1, 3, 2, 4]), batch(up([7, 5]), [1, 1])])))
    (out,) = key_scan._suspects((pa.scalar(9), pa.scalar(0)), iter(child + parent))
    assert out.column("print").to_pylist() == [5]


@pytest.mark.parametrize("limit", [2, 5, 1000])
def test_a_key_that_repeats_within_or_across_rows_is_a_suspect(limit):
    send = key_scan._send([key_scan.KeyRole(0, "c", "unique")], 1, limit)
    top = [n << 24 for n in (1, 2, 3, 4, 2, 9, 9, 9, 11)]
    sent = list(send(iter([pa.RecordBatch.from_arrays([pa.array([h], pa.int64())], names=["h0"]) for h in top])))
    (out,) = key_scan._suspects((pa.scalar(0), pa.scalar(0)), iter(sent))
    assert out.column("print").to_pylist() == [2, 9]


def _rows(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(4)


def _suite(spark, prepass, orders, items):
    tables = {"orders": _rows(spark, orders, "order_id string, n int"), "items": _rows(spark, items, "item_id long, order_id string")}
    suite = (Suite().add("orders", "order_id", "unique", "not_null").add("orders", "n", "unique").add("items", "item_id", "unique")
             .add("items", "order_id", ("relationships", (), "orders", "order_id")).add("orders", "order_id", ("relationships", (), "items", "order_id")))
    return {r.check_name: r.failures for r in run_suite(tables, suite.checks, prepass).collect()}


def test_suite_with_and_without_the_pre_pass(spark, monkeypatch):
    rng = random.Random(2)
    orders = [(f"o{k}", k) for k in range(3000)] + [("o1", None), ("o2", 5), ("o2", 5), (None, None), (None, 6), ("O1", None), ("", None)]
    items = [(k, f"o{rng.randint(0, 2500)}") for k in range(5000)] + [(k, "o7") for k in range(9000, 12_000)]  # a hot order
    items += [(1, "gone"), (2, "gone"), (20_001, "lost"), (20_002, None), (20_003, ""), (None, " o1")]
    want = _suite(spark, False, orders, items)
    assert want["unique_orders_order_id"] == 2 and want["relationships_items_order_id__orders_order_id"] == 4
    assert _suite(spark, True, orders, items) == want
    monkeypatch.setattr(checks, "SUSPECT_BITS", key_filter.CHUNK_BITS)  # a filter that nearly all keys pass
    assert _suite(spark, True, orders, items) == want


def test_only_suspects_are_left(spark):
    keys = _rows(spark, [(f"k{n}", f"k{n % 900}") for n in range(20_000)] + [("k3", "x"), ("k4", None)], "a string, b string")
    roles = [key_scan.KeyRole(0, "a", "unique"), key_scan.KeyRole(1, "b", "child"), key_scan.KeyRole(1, "a", "parent")]
    found = key_scan.suspects([(keys, roles)]).collect()
    marks = {r[0]: r[1:] for r in spark.createDataFrame([("k3",), ("k4",), ("x",)], "v string").select("v", F.shiftrightunsigned(F.xxhash64("v"), 24), F.shiftrightunsigned(F.xxhash64("v"), 8)).collect()}
    assert {(r.domain, r["print"]) for r in found} == {(0, marks["k3"][0]), (0, marks["k4"][0]), (1, marks["x"][1])}


def test_empty_tables(spark):
    assert set(_suite(spark, True, [], []).values()) == {0}
