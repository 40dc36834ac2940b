"""Segmented log-frequency Bloom filter over 64-bit keys.

A key's bucket has its own segment, so a reducer builds the segment of its
bucket alone and the whole is put together by laying segments side by side."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martforge.llm.common import Scratch, blob, mix, split_by

PROBES = 5  # hash functions a level
BITS_PER_ENTRY = PROBES / np.log(2)


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _bits(keys: np.ndarray, level: int, probe: int, size) -> np.ndarray:
    salt = ((probe + 1) * 0xA0761D6478BD642F + level * 0xE7037ED1A0B428DB) & 0xFFFFFFFFFFFFFFFF
    return (mix(keys + np.uint64(salt)) >> np.uint64(11)).astype(np.int64) % size


def build_segment(keys: np.ndarray, top: np.ndarray, bits_per_entry: float = BITS_PER_ENTRY) -> np.ndarray:
    """Packed bits of a segment that holds every key at the levels 1 .. top."""
    size = max(64, int(top.sum() * bits_per_entry + 63) // 64 * 64)
    bits = np.zeros(size, bool)
    level = 1
    while len(keys):
        for probe in range(PROBES):
            bits[_bits(keys, level, probe, size)] = True
        more = top > level
        keys, top, level = keys[more], top[more], level + 1
    return np.packbits(bits)


class Filter:
    """The segments of all buckets, side by side."""

    def __init__(self, segments: dict[int, bytes], n_buckets: int):
        sizes = np.zeros(n_buckets, np.int64)
        for b, bits in segments.items():
            sizes[b] = len(bits) * 8
        self.size, self.base = sizes, np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.bits = np.frombuffer(b"".join(segments[b] for b in sorted(segments)), np.uint8)

    def level(self, keys: np.ndarray, bucket: np.ndarray, most: int = 1 << 30) -> np.ndarray:
        """Highest level of every key up to ``most``, looked for in its bucket's segment; 0 if level 1 is missing."""
        size, base = self.size[bucket], self.base[bucket]
        out = np.zeros(len(keys), np.int64)
        at = np.flatnonzero(size)
        level = 1
        while len(at) and level <= most:
            for probe in range(PROBES):
                bit = base[at] + _bits(keys[at], level, probe, size[at])
                at = at[(self.bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1]
            out[at] = level
            level += 1
        return out


KEYED = "bucket int, keys binary, often binary"


def keyed_batch(keys: np.ndarray, n_buckets: int) -> pa.RecordBatch:
    """One batch's distinct keys by bucket, each marked if it stands more than once in the batch."""
    keys, counts = np.unique(keys, return_counts=True)
    order, cuts = split_by(bucket_of(keys, n_buckets), n_buckets)
    keys, often = keys[order], counts[order] > 1
    full = np.flatnonzero(np.diff(cuts)).tolist()
    return pa.RecordBatch.from_arrays([
        pa.array(full, pa.int32()), pa.array([blob(keys[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
        pa.array([blob(np.packbits(often[cuts[b] : cuts[b + 1]])) for b in full], pa.binary())], names=["bucket", "keys", "often"])


def _repeated(table: pa.Table) -> pa.Table:
    keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    often = np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=len(k)) for o, k in zip(table["often"].to_pylist(), keys)]).astype(bool)
    keys = np.concatenate(keys)
    order = np.argsort(keys)
    keys, often = keys[order], often[order]
    again = keys[1:] == keys[:-1]
    keys = np.unique(np.concatenate((keys[1:][again], keys[often])))
    return pa.table({"bucket": table["bucket"].slice(0, 1), "n": pa.array([len(keys)]), "keys": pa.array([blob(keys)], pa.binary())})


def keys_filter(keys: DataFrame, n_buckets: int, max_bytes: int) -> dict[int, bytes]:
    """Segments of a filter over the rows' keys (bucket, n, keys), at most ``max_bytes`` together.

    Beyond that size it lets more other keys pass; it never misses one."""
    total = keys.agg(F.sum("n")).first()[0] or 0
    bits = min(BITS_PER_ENTRY, max_bytes * 8 / max(1, total))

    def segment(table: pa.Table) -> pa.Table:
        found = np.unique(np.concatenate([np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]))
        return pa.table({"bucket": table["bucket"].slice(0, 1), "bits": pa.array([blob(build_segment(found, np.ones(len(found), np.int64), bits))], pa.binary())})

    segments = keys.filter("n > 0").groupBy("bucket").applyInArrow(segment, "bucket int, bits binary")
    return {r["bucket"]: bytes(r["bits"]) for r in segments.toLocalIterator()}


def repeated_filter(keyed: DataFrame, scratch: Scratch, n_buckets: int, max_bytes: int) -> dict[int, bytes]:
    """Filter of the keys that stand more than once in all batches of ``keyed`` together."""
    repeated = scratch.save(keyed.groupBy("bucket").applyInArrow(_repeated, "bucket int, n long, keys binary"), "repeated")
    found = keys_filter(repeated, n_buckets, max_bytes)
    scratch.drop(repeated)
    return found
