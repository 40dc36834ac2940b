"""Which keys can fail a unique or a relationship check, from packed fingerprints.

A check of keys compares every key with every other, so keys must meet in a
shuffle.  Here a fingerprint of a few bytes travels instead of the key's text:

* every task hashes its keys (in the JVM), keeps each fingerprint once, sorts
  them, and sends them as byte-wide differences, one row for each bucket of
  the hash range (numpy, in Arrow batches);
* a bucket's task merges them.  A fingerprint that was seen once belongs to one
  row, so its key is unique; a child's fingerprint without an equal parent's
  belongs to an orphan.  What is left over, the *suspects*, is returned.

Equal keys have equal fingerprints, so no repeated key and no orphan is missed
but one: an orphan whose 72-bit fingerprint is some parent's (a chance of one in
500,000 for 10^6 orphans and 10^10 parents).  Unequal keys may share a fingerprint of 40
bits; they become suspects and are cleared by an exact count.  A task holds at
most ``HELD`` keys of a column, and a key that fills a table is one entry a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of a fingerprint: of a key that must be unique, of a key that must have a parent (without its 16-bit tag)
UNIQUE_BITS, LINK_BITS = 40, 56
HELD = 2_000_000
SENT = "domain int, role int, bucket int, first long, width int, steps binary, tags binary, twice binary"


@dataclass(frozen=True)
class KeyRole:
    """A column's part in a check: ``domain`` is the set of keys it is compared in."""

    domain: int
    column: str
    kind: str  # unique | child | parent


ROLES = {"unique": 0, "child": 1, "parent": 2}


def key_hash(column: str | Column) -> Column:
    """The 64-bit hash of a key's text; NULL for a NULL key."""
    c = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(c.isNotNull(), F.xxhash64(c))


def _tag(column: str) -> Column:
    c = F.col(column).cast("string")
    return F.when(c.isNotNull(), F.hash(c, F.lit(1)).cast("long").bitwiseAND(F.lit(0xFFFF)).cast("int"))


def _pack(values: np.ndarray) -> tuple[int, int, bytes]:
    """(first, width, steps): sorted distinct uint64 as differences of ``width`` bytes each."""
    steps = np.diff(values)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return int(values[:1].view(np.int64)[0]), width, np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(first: int, width: int, steps: bytes) -> np.ndarray:
    raw = np.frombuffer(steps, np.uint8).reshape(-1, width)
    wide = np.zeros((len(raw) + 1, 8), np.uint8)
    wide[1:, :width] = raw
    out = wide.view("<u8").ravel().copy()
    out[0] = np.array([first], np.int64).view(np.uint64)[0]
    return np.cumsum(out, dtype=np.uint64)


def _buckets(values: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Bucket of each fingerprint, rising with it."""
    return ((values >> np.uint64(bits - 32)) * np.uint64(n)) >> np.uint64(32)


def _send(roles: Sequence[KeyRole], buckets: int, limit: int = HELD) -> Callable:
    """Hash columns h0, h1, .. (and tags t0, ..) of a model's rows -> packed rows of ``SENT``."""

    def rows(i: int, hashes: list[np.ndarray], tags: list[np.ndarray]) -> pa.RecordBatch:
        role = roles[i]
        bits = UNIQUE_BITS if role.kind == "unique" else LINK_BITS
        all_ = np.concatenate(hashes).view(np.uint64) >> np.uint64(64 - bits)
        if role.kind == "unique":
            values, times = np.unique(all_, return_counts=True)
            tag = None
        else:
            # copies of a key share both hash and tag; different keys of one hash keep a row each
            pair = np.empty(len(all_), [("h", np.uint64), ("t", np.uint16)])
            pair["h"], pair["t"] = all_, np.concatenate(tags)
            pair = pair[np.lexsort((pair["t"], pair["h"]))]
            pair = pair[np.append(True, pair[1:] != pair[:-1])] if len(pair) else pair
            values, tag, times = pair["h"].copy(), pair["t"].copy(), None
        at = _buckets(values, bits, buckets)
        cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        out: list[tuple] = []
        for lo, hi in zip(cuts, [*cuts[1:], len(values)]):
            some = values[lo:hi]
            first, width, steps = _pack(some)
            again = some[times[lo:hi] > 1].tobytes() if times is not None else b""
            out.append((role.domain, ROLES[role.kind], int(at[lo]), first, width, steps, b"" if tag is None else tag[lo:hi].tobytes(), again))
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[f.split()[0] for f in SENT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[list[np.ndarray]] = [[] for _ in roles]
        tags: list[list[np.ndarray]] = [[] for _ in roles]
        held = [0] * len(roles)
        for batch in batches:
            for i, role in enumerate(roles):
                h = batch.column(f"h{i}").drop_null()
                if not len(h):
                    continue
                hashes[i].append(h.to_numpy(zero_copy_only=False))
                if role.kind != "unique":
                    tags[i].append(batch.column(f"t{i}").drop_null().to_numpy(zero_copy_only=False))
                held[i] += len(h)
                if held[i] >= limit:
                    yield rows(i, hashes[i], tags[i])
                    hashes[i], tags[i], held[i] = [], [], 0
        for i in range(len(roles)):
            if held[i]:
                yield rows(i, hashes[i], tags[i])
    return run


def _suspects(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fingerprints of one domain and bucket that are not cleared."""
    seen: dict[int, list[np.ndarray]] = {0: [], 1: [], 2: []}
    tags: dict[int, list[np.ndarray]] = {1: [], 2: []}
    again: list[np.ndarray] = []
    for batch in batches:
        for r in batch.to_pylist():
            seen[r["role"]].append(_unpack(r["first"], r["width"], r["steps"]))
            if r["role"]:
                tags[r["role"]].append(np.frombuffer(r["tags"], np.uint16))
            again.append(np.frombuffer(r["twice"], np.uint64))
    out = [np.concatenate(again)] if again else []
    if seen[0]:
        values, times = np.unique(np.concatenate(seen[0]), return_counts=True)
        out.append(values[times > 1])
    if seen[1]:
        child, child_tag = np.concatenate(seen[1]), np.concatenate(tags[1])
        lost = np.ones(len(child), bool)
        if seen[2]:
            parent, parent_tag = np.concatenate(seen[2]), np.concatenate(tags[2])
            order = np.lexsort((parent_tag, parent))
            parent, parent_tag = parent[order], parent_tag[order]
            once = np.append(True, (parent[1:] != parent[:-1]) | (parent_tag[1:] != parent_tag[:-1]))  # a parent of several tasks
            parent, parent_tag = parent[once], parent_tag[once]
            lo, hi = np.searchsorted(parent, child, "left"), np.searchsorted(parent, child, "right")
            for step in range(int((hi - lo).max())):  # parents of one hash: one, but for collisions
                at = np.minimum(lo + step, len(parent) - 1)
                lost &= ~((lo + step < hi) & (parent_tag[at] == child_tag))
        out.append(child[lost])
    found = np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(found), pa.int32()), pa.array(found.view(np.int64), pa.int64())],
                                     names=["domain", "print"])


def suspects(models: Sequence[tuple[DataFrame, Sequence[KeyRole]]]) -> DataFrame:
    """``(domain int, print long)``: fingerprints of the keys that may fail a check.  Lazy; each model is read once."""
    sent = []
    for df, roles in models:
        buckets = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        columns = [key_hash(r.column).alias(f"h{i}") for i, r in enumerate(roles)]
        columns += [_tag(r.column).alias(f"t{i}") for i, r in enumerate(roles) if r.kind != "unique"]
        sent.append(df.select(*columns).mapInArrow(_send(roles, buckets), SENT))
    rows = sent[0]
    for more in sent[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("domain", "bucket").applyInArrow(_suspects, "domain int, print long")


def fingerprint(domain: Column, kind_is_unique: Column, hashed: Column) -> Column:
    """The ``print`` of a key as in ``suspects``, mixed with its domain, for one filter over all domains."""
    return F.xxhash64(domain, F.when(kind_is_unique, F.shiftrightunsigned(hashed, 64 - UNIQUE_BITS))
                      .otherwise(F.shiftrightunsigned(hashed, 64 - LINK_BITS)))
