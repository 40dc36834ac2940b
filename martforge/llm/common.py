"""Helpers shared by the operators of this subpackage.

* ``texts`` / ``read`` — the input columns an operator needs, nothing else, so
  extra or clashing columns of a caller never reach an operator's plan.
* ``Scratch`` — tables written to the shared folder (``spark.checkpoint.dir``)
  that cut lineage; a lost executor recomputes from files, not from the start.
* byte-level text helpers on Arrow buffers (numpy): words, span hashes and
  packed blobs that travel through shuffles as few, large binary rows.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martforge.session import checkpoint_dir

SPACE = "\\x20\\x09-\\x0D"
#: bytes that end a word of the plain (white-space) word rule
SPACE_BYTES = bytes([0x20, *range(0x09, 0x0E)])
#: characters that end a word of the letters-and-digits rule
PUNCT = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text) only; a null text is the empty text."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def with_fields(schema: T.StructType, *more: tuple[str, T.DataType]) -> T.StructType:
    """The schema with fields added at its end."""
    return T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in more)])


def buckets(spark: SparkSession) -> int:
    """Number of shuffle buckets: the session's shuffle width, which grows with the cluster's data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


class Scratch:
    """Intermediate tables of one operator call in the shared folder.

    ``save`` writes a DataFrame as Parquet and returns it reread.  ``drop``
    deletes tables that no later step reads; what an operator returns may still
    read the rest, which stay until the session's owner clears the folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._paths: dict[int, str] = {}

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:02d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self._paths.pop(id(frame), None)
            if path:
                delete(self.spark, path)
        # Spark deletes the shuffle files of finished steps when the driver notices that nothing refers to them
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def lean_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows for what the session runs next: a worker and its JVM hold some MB of text each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Marked for a broadcast if its counted rows (of some 50 bytes) allow it; the frame must be cheap to count."""
    return F.broadcast(df) if df.count() <= rows else df


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: a group is hot if it holds more than 1 / HOT_SHARE of all rows, so there are at most HOT_SHARE of them
HOT_SHARE = 1000


def join_counted(rows: DataFrame, groups: DataFrame, by: list[str], n: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` with the other columns of ``groups`` (one row a key ``by``, never null; ``n``: rows of the key).

    Hot groups, at most ``HOT_SHARE`` rows, are broadcast; the others meet their
    rows in a shuffle join, in which no key is hot."""
    side = groups.select(*[F.col(c).alias(f"g_{c}") for c in by], *[c for c in groups.columns if c not in by])
    on = [F.col(c) == F.col(f"g_{c}") for c in by]
    keys = [f"g_{c}" for c in by]
    hot_from = max(2, total // HOT_SHARE)
    marked = rows.join(F.broadcast(side.filter(F.col(n) >= hot_from)), on, "left")
    cold = marked.filter(F.col(n).isNull()).select(*rows.columns)
    others = cold.join(side.filter(F.col(n) < hot_from), on, how)
    return marked.filter(F.col(n).isNotNull()).unionByName(others).drop(*keys)


# --- hashing ---------------------------------------------------------------

_R = 0x9E3779B97F4A7C15  # odd multiplier of the polynomial span hash
_ROOT = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**63, 256, dtype=np.uint64)
BYTE_HASH = _ROOT * np.uint64(2) + np.uint64(1)
LOWER_HASH = BYTE_HASH.copy()
LOWER_HASH[65:91] = BYTE_HASH[97:123]
_POWERS: dict[str, np.ndarray] = {"r": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}
_BLOCK = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["r"]) < n:
        n = max(n, _BLOCK * 2)
        for key, base in (("r", _R), ("i", pow(_R, -1, 2**64))):
            steps = np.full(n, np.uint64(base), np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["r"], _POWERS["i"]


def prefix_hash(data: np.ndarray, table: np.ndarray = BYTE_HASH) -> tuple[np.ndarray, np.ndarray]:
    """(P, inverse powers): the hash of data[s:e] is (P[e] - P[s]) * inv[s]."""
    power, inverse = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * power[: len(data)], out=out[1:])
    return out, inverse


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit hash of every span (sorted, disjoint), in blocks of bounded size."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, "right")))
        lo = starts[at]
        p, inverse = prefix_hash(data[lo : ends[stop - 1]], table)
        s, e = starts[at:stop] - lo, ends[at:stop] - lo
        out[at:stop] = mix((p[e] - p[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = stop
    return out


# --- Arrow text ------------------------------------------------------------

def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column without nulls; no Python strings are made."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]


def pieces(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes (a longer document stands alone)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
        yield at, stop
        at = stop


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the white-space words, and the word range of each document."""
    inside = ~_IS_SPACE[data]
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    keep = inside[starts]
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(starts, offsets)


# --- packed rows -----------------------------------------------------------

def split_by(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that groups rows by bucket, and the n + 1 borders of the groups."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def blob(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
