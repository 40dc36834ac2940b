"""Language-model scores from a log-frequency Bloom filter.

Training counts every word and word pair of every training text exactly:
batches are counted first, then packed (hash, count) arrays are shuffled by
hash.  Each reducer quantises its counts on a log scale and enters an n-gram
once for every level up to its own into its segment of the filter; it also
gives the exact word table.  A pair's count is read back by probing level
after level until one is missing, and the smoothed probability of a word w
after v is (c(v, w) + d) / (c(v) + d (V + 1)).

The filter is broadcast in slices of at most ``SLICE_BYTES`` (or one context
word's share, if that is larger).  A pair lies in the slice of its first word,
so each slice scores its own tokens and the parts add up.  The number of
slices follows the corpus; there is one while the filter fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martforge.llm import common as C
from martforge.llm.bloom import Filter, bucket_of, build_segment

BASE = 1.5  # ratio of neighbouring quantisation levels
SMOOTHING = 0.01
SLICE_BYTES = 256 << 20
PIECE_BYTES = 1 << 20
START = np.uint64(0x5374617274205F31)
END = np.uint64(0x456E64205F5F5F32)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_GROUP_BITS = 12  # the low bits of a pair's key are those of its first word


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes with one END after each text, borders of the texts)."""
    starts, ends, border = C.words(data, offsets)
    hashes = C.span_hashes(data, starts, ends, C.LOWER_HASH)
    n = len(offsets) - 1
    borders = border + np.arange(n + 1)
    out = np.empty(len(hashes) + n, np.uint64)
    last = borders[1:] - 1
    fill = np.ones(len(out), bool)
    fill[last] = False
    out[fill], out[last] = hashes, END
    return out, borders


def pairs(token: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the pairs, their first words); the first word of a text follows START."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[borders[:-1]] = START
    low = np.uint64((1 << _GROUP_BITS) - 1)
    return (C.mix(before * _PAIR + token) & ~low) | (before & low), before


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised count: 1 for one, one more for each factor BASE."""
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def value(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for (0 for none)."""
    low, high = np.power(BASE, level - 1.0), np.power(BASE, level * 1.0)
    return np.where(level <= 0, 0.0, np.where(level == 1, 1.0, (low + high) / 2))


def _context_keys(words: np.ndarray) -> np.ndarray:
    """A word's own entry in the filter: its key as a context, in its own group."""
    low = np.uint64((1 << _GROUP_BITS) - 1)
    return (C.mix(words ^ np.uint64(0x1F83D9ABFB41BD6B)) & ~low) | (words & low)


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return (keys & np.uint64((1 << _GROUP_BITS) - 1)).astype(np.int64) % groups


COUNTED = "bucket int, kind string, keys binary, counts binary"
MODEL = "bucket int, grp int, kind string, n long, total long, a binary, b binary"


def count(training: DataFrame, n_buckets: int) -> DataFrame:
    """Packed (hash, count) arrays of each batch of (text), by bucket; kind w: words, p: pairs, c: contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = C.text_buffers(batch.column(0))
            found: dict[str, list[np.ndarray]] = {"w": [], "p": []}
            for lo, hi in C.pieces(offsets, PIECE_BYTES):
                token, borders = tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                found["w"].append(token)
                found["p"].append(pairs(token, borders)[0])
            rows = []
            for kind, parts in found.items():
                if not parts:
                    continue
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                order, cuts = C.split_by(bucket_of(keys, n_buckets), n_buckets)
                keys, counts = keys[order], counts[order].astype(np.uint32)
                rows += [(b, kind, C.blob(keys[cuts[b] : cuts[b + 1]]), C.blob(counts[cuts[b] : cuts[b + 1]]))
                         for b in np.flatnonzero(np.diff(cuts)).tolist()]
            if len(offsets) > 1:  # every text opens with START
                start = np.array([START])
                rows.append((int(bucket_of(start, n_buckets)[0]), "s", C.blob(start), C.blob(np.array([len(offsets) - 1], np.uint32))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["bucket", "kind", "keys", "counts"]).cast(
                    pa.schema([("bucket", pa.int32()), ("kind", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())]))

    return training.mapInArrow(run, COUNTED)


def _summed(table: pa.Table, kinds: str) -> tuple[np.ndarray, np.ndarray]:
    keep = [i for i, k in enumerate(table["kind"].to_pylist()) if k in kinds]
    keys = [np.frombuffer(table["keys"][i].as_py(), np.uint64) for i in keep]
    counts = [np.frombuffer(table["counts"][i].as_py(), np.uint32) for i in keep]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64)


def build(counted: DataFrame, n_buckets: int, groups: int) -> DataFrame:
    """Rows of the model by (bucket, group): exact word tables (w), filter segments of pairs (p).

    Contexts' own counts come back as packed pieces (c) for their buckets."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        rows = []
        words, n = _summed(table, "w")
        group = _group(words, groups)
        for g in np.unique(group).tolist():
            mine = group == g
            rows.append((bucket, g, "w", int(mine.sum()), int(n[mine].sum()), C.blob(words[mine]), C.blob(n[mine])))
        keys, n = _summed(table, "p")
        group = _group(keys, groups)
        for g in np.unique(group).tolist():
            mine = group == g
            rows.append((bucket, g, "p", int(mine.sum()), int(n[mine].sum()), C.blob(build_segment(keys[mine], levels(n[mine]))), b""))
        words, n = _summed(table, "ws")
        group = _group(words, groups)
        for g in np.unique(group).tolist():
            mine = (group == g) & (words != END)
            rows.append((bucket, g, "c", int(mine.sum()), 0, C.blob(build_segment(_context_keys(words[mine]), levels(n[mine]))), b""))
        return pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], names=[f.split()[0] for f in MODEL.split(", ")]).cast(pa.schema([
            ("bucket", pa.int32()), ("grp", pa.int32()), ("kind", pa.string()), ("n", pa.int64()), ("total", pa.int64()),
            ("a", pa.binary()), ("b", pa.binary())]))

    return counted.groupBy("bucket").applyInArrow(run, MODEL)


class Slice:
    """What scores the tokens of some groups: exact words (by the word), pairs and contexts (by the context)."""

    def __init__(self, rows: list, n_buckets: int, groups: int, mine: set[int], n: int, v: int):
        self.n, self.v, self.groups, self.n_buckets = n, v, groups, n_buckets
        self.mine = np.array([g in mine for g in range(groups)])
        words = [(np.frombuffer(a, np.uint64), np.frombuffer(b, np.int64)) for _, _, kind, a, b in rows if kind == "w"]
        keys = np.concatenate([w for w, _ in words]) if words else np.zeros(0, np.uint64)
        order = np.argsort(keys)
        self.words, self.counts = keys[order], (np.concatenate([c for _, c in words]) if words else np.zeros(0, np.int64))[order]
        by: dict[str, dict[int, dict[int, bytes]]] = {"p": {}, "c": {}}
        for bucket, group, kind, bits, _ in rows:
            if kind in by:
                by[kind].setdefault(group, {})[bucket] = bits
        self.pairs = {g: Filter(s, n_buckets) for g, s in by["p"].items()}
        self.contexts = {g: Filter(s, n_buckets) for g, s in by["c"].items()}

    def word_counts(self, token: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(token), np.int64)
        at = np.minimum(np.searchsorted(self.words, token), len(self.words) - 1)
        return np.where(self.words[at] == token, self.counts[at], 0)

    def _levels(self, filters: dict[int, Filter], keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        out, group = np.zeros(len(keys), np.int64), _group(keys, self.groups)
        for g, f in filters.items():
            at = np.flatnonzero(group == g) if self.groups > 1 else slice(None)
            out[at] = f.level(keys[at], bucket[at])
        return out

    def score(self, token: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """This slice's part of each text's known tokens, base score and model score."""
        own = self.mine[_group(token, self.groups)]
        counts = np.where(own, self.word_counts(token), 0)
        base = np.where(own, np.log10((counts + 1) / (self.n + self.v + 1)), 0.0)
        keys, before = pairs(token, borders)
        after = value(self._levels(self.pairs, keys, bucket_of(keys, self.n_buckets)))
        first, where = np.unique(before, return_inverse=True)
        context = value(self._levels(self.contexts, _context_keys(first), bucket_of(first, self.n_buckets)))[where]
        context = np.maximum(context, after)
        model = np.where(self.mine[_group(keys, self.groups)], np.log10((after + SMOOTHING) / (context + SMOOTHING * (self.v + 1))), 0.0)
        at = borders[:-1]
        return np.add.reduceat(counts > 0, at, dtype=np.int64), np.add.reduceat(base, at), np.add.reduceat(model, at)


SCORES = "doc_id long, th long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo 7, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def score(docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    A null text is the empty text, which is one end token.  Rows that repeat a
    doc_id are scored each by its own text; without training documents N and V
    are 0."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "lm")
    rows = C.texts(docs).withColumn("held_out", held_out())
    n_buckets = C.buckets(spark)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = 1
    while groups < (1 << _GROUP_BITS) and groups * slice_bytes < size:  # a group's filter is surely smaller than its share of the text
        groups *= 2
    counted = count(rows.filter(~F.col("held_out")).select("text"), n_buckets)
    model = scratch.save(build(counted, n_buckets, groups), "model")
    sizes = model.groupBy("grp").agg(F.sum(F.length("a") + F.length("b")).alias("bytes")).collect()  # one row a group
    totals = model.filter("kind = 'w'").agg(F.sum("total"), F.sum("n")).first()
    n, v = totals[0] or 0, totals[1] or 0
    slices: list[set[int]] = [set()]
    held = 0
    for r in sorted(sizes):
        if slices[-1] and held + r["bytes"] > slice_bytes:
            slices.append(set())
            held = 0
        slices[-1].add(r["grp"])
        held += r["bytes"]
    slices[-1] |= set(range(groups)) - {r["grp"] for r in sizes}
    parts = None
    for mine in slices:
        found = model.filter(F.col("grp").isin(sorted(mine))).select("bucket", "grp", "kind", "a", "b")
        chosen = [(r[0], r[1], r[2], bytes(r[3]), bytes(r[4])) for r in found.toLocalIterator()]  # at most slice_bytes, or one group
        sent = spark.sparkContext.broadcast(Slice(chosen, n_buckets, groups, mine, n, v))  # put together once, so that workers hold one copy
        del chosen
        part = rows.withColumn("th", F.xxhash64("text")).select("doc_id", "th", "held_out", "text").mapInArrow(_scorer(sent), SCORES)
        parts = part if parts is None else parts.unionByName(part)
    if len(slices) > 1:  # every row gave a part in every slice
        copies = F.count("*") / len(slices)
        parts = parts.groupBy("doc_id", "th", "held_out", "n_tokens").agg(
            copies.alias("copies"), (F.sum("n_known") / copies).cast("long").alias("n_known"),
            (F.sum("base_score") / copies).alias("base_score"), (F.sum("score") / copies).alias("score"),
        ).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return parts.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def _scorer(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = sent.value
        for batch in batches:
            offsets, data = C.text_buffers(batch.column(3))
            for lo, hi in C.pieces(offsets, PIECE_BYTES):
                token, borders = tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                known, base, model = ready.score(token, borders)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(np.diff(borders).astype(np.int64)), pa.array(known), pa.array(base), pa.array(model)],
                    names=[f.split()[0] for f in SCORES.split(", ")])
    return run


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(C.read(spark, sf_dir, "documents"))
