"""Exact dedup against a dict of normalised texts, also under a hash that collides all the time."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from martforge.llm import exact_dedup
from tests.llm.conftest import SCHEMA, got


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _check(frame, rows):
    """Everything but which of equal (id, text) rows is kept is fixed; of those exactly one may be."""
    groups = {}
    for r in rows:
        groups.setdefault(_norm(r[1]), []).append(r[0])
    want, kept_want = [], set()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        kept_want.add((keep, text))
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, keep, len(ids), sha) for i in ids]
    rows_out = frame.collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows_out), key=key) == sorted(want, key=key)
    kept = [(r.doc_id, r.text_sha256) for r in rows_out if r.kept]
    assert sorted(kept, key=key) == sorted(((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in kept_want), key=key)


def test_groups_equal_brute_force(docs, rows):
    _check(exact_dedup.dedup(docs), rows)


@pytest.mark.parametrize("digest", [lambda t: F.unhex(F.hex(F.length(t))), lambda t: F.lit(b"one"), lambda t: F.substring(F.unhex(F.md5(t)), 1, 1)])
def test_colliding_hashes_are_told_apart_by_bytes(docs, rows, digest):
    _check(exact_dedup.dedup(docs, digest=digest), rows)


def test_a_hot_group_and_unlucky_columns(spark):
    rows = [(i, "the same  text" if i % 3 else "the same\ttext") for i in range(3000)] + [(5000 + i, f"text {i % 700}") for i in range(1400)]
    frame = spark.createDataFrame([(i, t, 1, "x", True, 2, "y") for i, t in rows],
                                  "doc_id long, text string, pos int, h string, first boolean, n int, g_h string").repartition(5)
    _check(exact_dedup.dedup(frame), rows)


def test_empty_and_all_null(spark, none):
    assert got(exact_dedup.dedup(none)) == []
    rows = [(None, None), (None, ""), (None, " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((r.group_size, r.kept, r.keep_id) for r in exact_dedup.dedup(frame).collect())
    assert out == [(1, True, None), (2, False, None), (2, True, None)]
    assert SCHEMA.startswith("doc_id long")
