"""Whitening against numpy on all rows at once, with copies, odd rows and degenerate tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martforge.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, x int, h string, d int, white string, copies int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "h", 3, "w", 4) for i, v in rows], SCHEMA)


def _brute(rows, components=8):
    """{row: (d, n, deviation, whitened up to sign, explained)}, per length of vector."""
    kept = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for d in {len(v) for _, v in kept}:
        some = [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v in kept if len(v) == d]
        n = len(some)
        s = [sum(x[k] for _, x in some) for k in range(d)]
        y = np.array([[(n * x[k] - s[k]) / n for k in range(d)] for _, x in some])
        v = y.T @ y / n
        e, u = np.linalg.eigh(v)
        top = np.argsort(e)[::-1][:components]
        for (i, x), row in zip(some, y):
            dev = sum((n * x[k] - s[k]) ** 2 for k in range(d))
            for c, at in enumerate(top):
                out.append((i, c + 1, n, dev, row @ u[:, at] / math.sqrt(e[at]) if e[at] > 1e-9 * e[top[0]] else None, e[at] / np.trace(v) if np.trace(v) else 0.0))
    return out


def _same(frame, rows):
    got = sorted(frame.collect(), key=lambda r: (r.vec_id is None, r.vec_id or 0, r.n, r.component, r.deviation))
    want = sorted(_brute(rows), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1], r[3]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [r[:4] for r in want]
    signs = {}
    for g, w in zip(got, want):
        assert g.explained == pytest.approx(w[5], rel=1e-6, abs=1e-12) and g.identity_error < 1e-6
        if w[4] is None:
            assert g.whitened is None
            continue
        if abs(w[4]) > 1e-3:
            sign = signs.setdefault((g.n, g.component), math.copysign(1, g.whitened * w[4]))
            assert g.whitened == pytest.approx(sign * w[4], rel=1e-6, abs=1e-7)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(12, 12)) * np.linspace(0.05, 1, 12)
    base = (rng.normal(size=(150, 12)) @ mix).astype(np.float32)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]  # a hot vector
    rows += [(2000 + k, [c + 1e-6 for c in rows[k][1]]) for k in range(20)]  # mostly the same x
    return rows + [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (5000, None), (5001, []), (5002, [None] + rows[0][1][1:]),
                   (5003, [float("nan")] * 12), (5004, [float("inf")] + [0.0] * 11)]


def test_whitening_equals_numpy(spark, rows):
    _same(whitening.whiten(_frame(spark, rows).repartition(4)), rows)


def test_a_shared_hash_joins_by_the_vector(spark, rows):
    _same(whitening.whiten(_frame(spark, rows).repartition(3), digest=lambda x: F.xxhash64(F.element_at(x, 1) % 3)), rows)


def test_lengths_are_fitted_apart(spark, rows):
    more = rows + [(7000 + k, [float(k), float(k * k % 7), float(k % 3)]) for k in range(30)]
    _same(whitening.whiten(_frame(spark, more)), more)


def test_one_weight_a_distinct_vector(spark, rows):
    once = {tuple(v): (i, v) for i, v in reversed(rows) if v and i is not None and i < 2000 and all(c is not None and math.isfinite(c) for c in v)}
    a = whitening.whiten(_frame(spark, list(once.values())))
    b = whitening.whiten(_frame(spark, [r for r in rows if r[0] is not None and r[0] < 2000]), by_count=False)
    assert a.first().n == b.first().n == len(once)
    values = lambda f: sorted((round(abs(r.whitened), 6) for r in f.filter("vec_id = 20").collect()))
    assert values(a) == pytest.approx(values(b), abs=1e-5)


def test_degenerate_tables(spark, rows):
    assert whitening.whiten(_frame(spark, [])).collect() == []
    assert whitening.whiten(_frame(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(_frame(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 1, 0, None, 0.0), (2, 1, 0, None, 0.0)]
    line = [(k, [float(k), 2.0 * k, 0.0]) for k in range(5)]  # rank one
    _same(whitening.whiten(_frame(spark, line)), line)
    huge = whitening.whiten(_frame(spark, [(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.0])])).collect()
    assert {r.deviation for r in huge if r.vec_id != 3} == {None} and all(r.n == 3 for r in huge)
