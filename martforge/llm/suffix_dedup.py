"""Exact removal of repeated byte strings by difference-cover suffix sorting.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts
earlier (smaller doc_id, or earlier in the same document).

1. Every window of ``LENGTH`` bytes has a key: the smallest hash of its
   ``GRAM``-byte strings.  Equal windows have equal keys, so only windows
   whose key stands at two or more places can be repeated.  Keys are counted
   over all text; the repeated ones go into a Bloom filter of bounded size (a
   false positive costs work, never a wrong answer).
2. Windows with a repeated key are dealt out by key, as short stretches of
   text (neighbouring windows with one key); equal stretches of a batch are
   sent once.  All places of a repeated string meet in one bucket.  A key with
   more than ``HOT`` places (a passage that many documents hold) is not kept
   together: those of its windows whose own hash is repeated are dealt out one
   by one, by that hash, so text around the passage does not travel with it.
   What is known to be covered goes on as a range, to the batch's own bucket.
3. Each bucket sorts the suffixes of its distinct stretches with the
   difference-cover algorithm: sort the triples at positions 1 and 2 mod 3,
   recurse on their names (until names cover ``LENGTH`` bytes), sort the
   remaining suffixes by their first symbol and the rank behind it, merge.
   Adjacent suffixes with equal ``LENGTH``-byte prefixes are one string; all
   its places but the first are covered.
4. Covered ranges are joined to their documents and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from martforge.llm import common as C
from martforge.llm.bloom import KEYED, Filter, bucket_of, keyed_batch, keys_filter, repeated_filter

LENGTH = 100
GRAM = 36
RUN = LENGTH - GRAM + 1  # grams in a window
STRETCH = 64  # windows in a stretch
PIECE_BYTES = 1 << 18
SEND_BYTES = 1 << 22  # text whose stretches are gathered before they are sent
BUCKETS = 16  # buckets of stretches for each shuffle partition: sorting a bucket takes some 60 times its bytes of memory
FILTER_BYTES = 256 << 20  # of the broadcast filter; beyond it the filter prunes less
HOT = 4096  # places of a key from which on its windows are dealt out one by one; keeps a key's stretches under 1 MB
HOT_FILTER_BYTES = 64 << 20  # of the filter of such windows
NO_ID = -(1 << 63)  # stands for a null doc_id, which sorts first


# --- window keys -------------------------------------------------------------

def _gram_hashes(data: np.ndarray) -> np.ndarray:
    p, inverse = C.prefix_hash(data)
    h = (p[GRAM:] - p[:-GRAM]) * inverse[: len(p) - GRAM]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    return h >> np.uint64(7)


def _sliding_min(h: np.ndarray) -> np.ndarray:
    """Minimum of every RUN neighbours: prefix and suffix minima of blocks of RUN."""
    n = len(h)
    blocks = np.full(-(-n // RUN) * RUN, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:n] = h
    blocks = blocks.reshape(-1, RUN)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(right[: n - RUN + 1], left[RUN - 1 : n])


def _valid(offsets: np.ndarray, n: int) -> np.ndarray:
    """Which of the first n places begin a window that ends within its document."""
    step = np.zeros(n + 1, np.int32)
    stops = np.maximum(offsets[1:] - LENGTH + 1, offsets[:-1])
    np.add.at(step, np.minimum(offsets[:-1], n), 1)
    np.add.at(step, np.minimum(stops, n), -1)
    return np.cumsum(step[:n]) > 0


def gram_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Keys of all windows, once for every place of the gram that gives it (of equal grams in a window: the outermost two)."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64)
    h = _gram_hashes(data)
    place = np.arange(len(h), dtype=np.uint64) & np.uint64(127)
    found = []
    fine = _valid(offsets, len(h) - RUN + 1)
    starts = np.arange(len(fine), dtype=np.int64)
    for low in (place, np.uint64(127) - place):
        m = _sliding_min(h << np.uint64(7) | low)
        cut = np.concatenate(([True], (m[1:] != m[:-1]) | (fine[1:] & ~fine[:-1]))) & fine
        m, at = m[cut], starts[cut]
        where = (m & np.uint64(127)).astype(np.int64)
        where = where if low is place else 127 - where
        found.append(at + ((where - at) & 127))
    both = np.unique(np.concatenate(found))
    return h[both]


def runs(data: np.ndarray, offsets: np.ndarray, wanted) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, number of windows) of a document's neighbouring windows with one key that is ``wanted``."""
    if len(data) < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = _sliding_min(_gram_hashes(data))
    fine = _valid(offsets, len(m))
    edge = np.zeros(len(m), bool)
    edge[0] = True
    np.logical_or(m[1:] != m[:-1], fine[1:] != fine[:-1], out=edge[1:])
    edge[offsets[(offsets < len(m))]] = True
    at = np.flatnonzero(edge)
    size = np.diff(np.append(at, len(m)))
    keep = fine[at]
    at, size = at[keep], size[keep]
    keep = wanted(m[at])
    return m[at[keep]], at[keep], size[keep]


def stretches(key: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs in parts of at most STRETCH windows."""
    parts = -(-size // STRETCH)
    which = np.repeat(np.arange(len(at)), parts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    return key[which], at[which] + nth * STRETCH, np.minimum(size[which] - nth * STRETCH, STRETCH)


def _among(ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys stand in an ordered array."""
    if not len(ordered):
        return np.zeros(len(keys), bool)
    return ordered[np.minimum(np.searchsorted(ordered, keys), len(ordered) - 1)] == keys


def windows_of(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of its bytes, place) of every window of the runs."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    places = np.repeat(at - np.cumsum(size) + size, size) + np.arange(size.sum())
    p, inverse = C.prefix_hash(data)
    return C.mix((p[places + LENGTH] - p[places]) * inverse[places]), places


# --- difference-cover suffix sorting ----------------------------------------

def _pack(*columns: np.ndarray) -> np.ndarray:
    """One integer per row that sorts as the rows do."""
    out = columns[0].astype(np.int64)
    for c in columns[1:]:
        width = int(c.max(initial=0)) + 1
        if int(out.max(initial=0)) >= (1 << 62) // width:
            out = np.unique(out, return_inverse=True)[1].astype(np.int64)
        out = out * width + c
    return out


def suffix_order(s: np.ndarray, width: int, limit: int) -> np.ndarray:
    """Places of s in the order of the suffixes that begin there, as far as ``limit`` bytes tell.

    s: symbols of ``width`` bytes each, 0 for separators."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(s[i:])), np.int64)
    t = np.concatenate((s, np.zeros(3, s.dtype)))
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    triple = _pack(t[sample], t[sample + 1], t[sample + 2])
    order = np.argsort(triple)
    ordered = triple[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    if not new.all() and 3 * width < limit:  # names repeat: sort the string of names
        names = np.empty(len(sample), np.int64)
        names[order] = np.cumsum(new)
        reduced = np.concatenate((names[: len(one)], [0], names[len(one):]))
        del triple, order, ordered, new, names
        order = suffix_order(reduced, 3 * width, limit)
        order = order[order != len(one)]
        order = order - (order > len(one))
    sorted_sample = sample[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sorted_sample] = np.arange(1, len(sample) + 1)
    sorted_sample = sorted_sample[sorted_sample < n]  # without the place behind the end
    rest = np.arange(0, n, 3)
    rest = rest[np.argsort(_pack(t[rest], rank[rest + 1]))]
    # of the sample: those at 1 mod 3 are compared by one symbol, those at 2 mod 3 by two
    is_one = sorted_sample % 3 == 1
    first, second = sorted_sample[is_one], sorted_sample[~is_one]
    a = _pack(np.concatenate((t[first], t[rest])), np.concatenate((rank[first + 1], rank[rest + 1])))
    b = _pack(*(np.concatenate((x[second + d], x[rest + d])) for x, d in ((t, 0), (t, 1), (rank, 2))))
    before = np.searchsorted(a[: len(first)], a[len(first):]) + np.searchsorted(b[: len(second)], b[len(second):])
    place = np.arange(len(rest)) + np.maximum.accumulate(before)
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place], out[~taken] = rest, sorted_sample
    return out


def _same(raw: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the LENGTH bytes at ``left`` and ``right`` are equal, pair by pair."""
    raw = np.concatenate((raw, np.zeros(8, np.uint8)))
    words = np.zeros(len(raw) - 7, np.uint64)
    for i in range(8):
        words |= raw[i : len(raw) - 7 + i].astype(np.uint64) << np.uint64(8 * i)
    at = np.arange(len(left))
    for d in [*range(0, LENGTH - 8, 8), LENGTH - 8]:  # eight bytes at a time
        at = at[words[left[at] + d] == words[right[at] + d]]
    same = np.zeros(len(left), bool)
    same[at] = True
    return same


def equal_windows(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts in suffix order, class): starts whose LENGTH bytes are equal have one class.

    text: bytes + 1, separators 0; every start has LENGTH bytes before a separator."""
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = suffix_order(text, 1, LENGTH)
    order = order[wanted[order]]
    same = _same((text - 1).astype(np.uint8), order[:-1], order[1:])
    return order, np.cumsum(np.concatenate(([True], ~same))) - 1 if len(order) else np.zeros(0, np.int64)


# --- the distributed steps -----------------------------------------------------

def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(t).alias("th"), t.alias("text"))


COUNTED = KEYED + ", counts binary"


def _count_keys(n_buckets: int):
    """Distinct keys of each batch; ``counts`` has the places of those that stand more than once in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = C.text_buffers(batch.column(0))
            found = [gram_keys(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in C.pieces(offsets, PIECE_BYTES)]
            if not found:
                continue
            keys, counts = np.unique(np.concatenate(found) << np.uint64(7), return_counts=True)
            order, cuts = C.split_by(bucket_of(keys, n_buckets), n_buckets)
            keys, counts = keys[order], counts[order].astype(np.uint32)
            parts = [(b, keys[cuts[b] : cuts[b + 1]], counts[cuts[b] : cuts[b + 1]]) for b in np.flatnonzero(np.diff(cuts)).tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([b for b, _, _ in parts], pa.int32()), pa.array([C.blob(k) for _, k, _ in parts], pa.binary()),
                pa.array([C.blob(np.packbits(c > 1)) for _, _, c in parts], pa.binary()),
                pa.array([C.blob(c[c > 1]) for _, _, c in parts], pa.binary())], names=[f.split()[0] for f in COUNTED.split(", ")])
    return run


def _repeated_keys(hot: int):
    """A bucket's keys with more than one place, and those with more than ``hot``."""
    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
        counts = [np.ones(len(k), np.uint32) for k in keys]
        for c, often, n in zip(counts, table["often"].to_pylist(), table["counts"].to_pylist()):
            c[np.unpackbits(np.frombuffer(often, np.uint8), count=len(c)).astype(bool)] = np.frombuffer(n, np.uint32)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        keys, counts = keys[at], np.add.reduceat(counts, at, dtype=np.int64)
        again = keys[counts > 1]
        return pa.table({"bucket": table["bucket"].slice(0, 1), "n": pa.array([len(again)]), "keys": pa.array([C.blob(again)], pa.binary()),
                         "hot": pa.array([C.blob(keys[counts > hot])], pa.binary())})
    return run


def _count_windows(hot_keys, n_buckets: int):
    """Hashes of the windows whose key is hot, 4 MB of text at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = hot_keys.value
        for batch in batches:
            offsets, data = C.text_buffers(batch.column(0))
            for begin, end in C.pieces(offsets, SEND_BYTES):
                found = []
                for lo, hi in C.pieces(offsets[begin : end + 1], PIECE_BYTES):
                    lo, hi = lo + begin, hi + begin
                    some = data[offsets[lo] : offsets[hi]]
                    _, at, size = runs(some, offsets[lo : hi + 1] - offsets[lo], lambda keys: _among(hot, keys << np.uint64(7)))
                    found.append(windows_of(some, at, size)[0])
                if sum(map(len, found)):
                    yield keyed_batch(np.concatenate(found), n_buckets)
    return run


def _send(sent, n_buckets: int):
    """Stretches with a repeated key, by bucket; a later equal stretch of the batch is covered by the first and sent as a range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, hot, hot_segments, filter_buckets = sent.value
        bloom, windows = Filter(segments, filter_buckets), Filter(hot_segments, filter_buckets)

        def known(keys: np.ndarray) -> np.ndarray:
            return bloom.level(keys << np.uint64(7), bucket_of(keys << np.uint64(7), filter_buckets), 1) > 0

        def again(hashes: np.ndarray) -> np.ndarray:
            return windows.level(hashes, bucket_of(hashes, filter_buckets), 1) > 0

        for batch in batches:
            offsets, _ = C.text_buffers(batch["text"])
            for lo, hi in C.pieces(offsets, SEND_BYTES):
                rows = deal(batch.slice(lo, hi - lo), known, hot, again)
                if rows:
                    yield rows

    def deal(batch: pa.RecordBatch, known, hot: np.ndarray, again) -> pa.RecordBatch | None:
        batch = batch.take(pa.compute.sort_indices(batch, [("did", "ascending"), ("th", "ascending")]))
        did, th = batch["did"].to_numpy(), batch["th"].to_numpy()
        offsets, data = C.text_buffers(batch["text"])
        rows: dict[int, list] = {}
        seen: dict[bytes, tuple[int, int]] = {}
        covered: list[tuple] = []
        singles = []
        for lo, hi in C.pieces(offsets, PIECE_BYTES):
            base = offsets[lo]
            some = data[base : offsets[hi]]
            key, at, size = runs(some, offsets[lo : hi + 1] - base, known)
            is_hot = _among(hot, key << np.uint64(7))
            if is_hot.any():
                hashes, places = windows_of(some, at[is_hot], size[is_hot])
                keep = again(hashes)
                singles.append((hashes[keep], places[keep] + base))
            key, first, size = stretches(key[~is_hot], at[~is_hot], size[~is_hot])
            doc = lo + np.searchsorted(offsets[lo : hi + 1] - base, first, "right") - 1
            start = first + base - offsets[doc]
            raw = some.tobytes()
            for b, d, f, s, w in zip(bucket_of(key << np.uint64(7), n_buckets).tolist(), doc.tolist(), first.tolist(), start.tolist(), size.tolist()):
                text = raw[f : f + w + LENGTH - 1]
                mine = (int(did[d]), s)
                if seen.setdefault(text, mine) < mine:
                    covered.append((did[d], th[d], s, w, True, b""))
                else:
                    rows.setdefault(b, []).append((did[d], th[d], s, w, False, text))
        if singles:
            hashes, places = (np.concatenate(x) for x in zip(*singles))
            doc = np.searchsorted(offsets, places, "right") - 1
            start = places - offsets[doc]
            where = np.unique(did, return_inverse=True)[1][doc] << 32 | start
            order = np.lexsort((where, hashes))
            fresh = np.concatenate(([True], hashes[order[1:]] != hashes[order[:-1]]))[: len(order)]
            lead = np.empty(len(order), np.int64)
            lead[order] = order[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            later = (where > where[lead]) & _same(data, places, places[lead])
            for b, i in zip(bucket_of(hashes[~later], n_buckets).tolist(), np.flatnonzero(~later).tolist()):
                d = doc[i]
                rows.setdefault(b, []).append((did[d], th[d], start[i], 1, False, data[places[i] : places[i] + LENGTH].tobytes()))
            gone = np.flatnonzero(later)  # places ascend: neighbouring windows become one range
            edge = np.concatenate(([True], (places[gone[1:]] != places[gone[:-1]] + 1) | (doc[gone[1:]] != doc[gone[:-1]])))[: len(gone)]
            begin = np.flatnonzero(edge)
            for i, w in zip(gone[begin].tolist(), np.diff(np.append(begin, len(gone))).tolist()):
                covered.append((did[doc[i]], th[doc[i]], start[i], w, True, b""))
        if covered:  # ranges need no other row: any bucket will do
            own = int(C.mix(th[:1].astype(np.uint64))[0] % np.uint64(n_buckets))
            rows.setdefault(own, []).extend(covered)
        packed = []
        for b, found in rows.items():
            d, t, s, w, c, x = zip(*found)
            packed.append((b, C.blob(np.array(d, np.int64)), C.blob(np.array(t, np.int64)), C.blob(np.array(s, np.int32)),
                           C.blob(np.array(w, np.int32)), C.blob(np.array(c, np.uint8)), b"".join(x)))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*packed))], names=SENT_NAMES) if packed else None

    return run


SENT = "bucket int, did binary, th binary, start binary, windows binary, covered binary, text binary"
SENT_NAMES = [f.split()[0] for f in SENT.split(", ")]
RANGES = "did long, th long, first int, last int"


def _cover(table: pa.Table) -> pa.Table:
    """Covered ranges [first, last) of one bucket's stretches."""
    def column(name: str, kind) -> np.ndarray:
        return np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])

    did, th, start = column("did", np.int64), column("th", np.int64), column("start", np.int32).astype(np.int64)
    size, covered = column("windows", np.int32).astype(np.int64), column("covered", np.uint8).astype(bool)
    out = [(did[covered], th[covered], start[covered], start[covered] + size[covered] + LENGTH - 1)]
    did, th, start, size = (x[~covered] for x in (did, th, start, size))
    text = b"".join(table["text"].to_pylist())
    ends = np.cumsum(size + LENGTH - 1)
    # the first place of each distinct stretch; its other places are covered
    order = np.lexsort((start, did))
    firsts: dict[bytes, int] = {}
    chosen, again, lead = [], [], []
    for i in order.tolist():
        piece = text[ends[i] - size[i] - LENGTH + 1 : ends[i]]
        f = firsts.setdefault(piece, i)
        if f == i:
            chosen.append(i)
        else:
            again.append(i)
            lead.append(f)
    again, lead = np.array(again, np.int64), np.array(lead, np.int64)
    later = (did[again] > did[lead]) | (start[again] > start[lead])
    full = again[later]
    out.append((did[full], th[full], start[full], start[full] + size[full] + LENGTH - 1))
    # distinct stretches end to end, each followed by a separator
    picked = np.array(chosen, np.int64)
    joined = np.frombuffer(b"\0".join(firsts) + b"\0", np.uint8).astype(np.int64) + 1
    length = size[picked] + LENGTH - 1
    base = np.cumsum(length + 1) - length - 1
    joined[base + length] = 0
    windows = np.repeat(np.arange(len(picked)), size[picked])
    offset = np.arange(len(windows)) - np.repeat(np.cumsum(size[picked]) - size[picked], size[picked])
    at, group = equal_windows(joined, base[windows] + offset)
    rank = np.unique(did[picked], return_inverse=True)[1]
    where = np.zeros(len(joined), np.int64)
    where[base[windows] + offset] = np.arange(len(windows))
    w = where[at]
    place = rank[windows[w]] << 32 | (start[picked][windows[w]] + offset[w])
    if len(w):
        least = np.minimum.reduceat(place, np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))))
        hit = np.sort(w[place > least[group]])
        if len(hit):  # neighbouring windows of a stretch become one range
            cut = np.concatenate(([True], (hit[1:] != hit[:-1] + 1) | (windows[hit[1:]] != windows[hit[:-1]])))
            lo, hi = hit[cut], hit[np.append(np.flatnonzero(cut)[1:] - 1, len(hit) - 1)]
            p = picked[windows[lo]]
            out.append((did[p], th[p], start[p] + offset[lo], start[p] + offset[hi] + LENGTH))
            # a row that repeats document and text is covered where that document is
            same = {}
            for a, f in zip(again[~later].tolist(), lead[~later].tolist()):
                same.setdefault(f, set()).add(int(th[a]))
            for f, others in same.items():
                mine = p == f
                for other in others - {int(th[f])}:
                    out.append((did[p[mine]], np.full(mine.sum(), other), start[p[mine]] + offset[lo[mine]], start[p[mine]] + offset[hi[mine]] + LENGTH))
    d, t, a, b = (np.concatenate(x) for x in zip(*out))
    return pa.table({"did": pa.array(d, pa.int64()), "th": pa.array(t, pa.int64()), "first": pa.array(a.astype(np.int32)), "last": pa.array(b.astype(np.int32))})


def covered_ranges(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(did, th, first, last): byte ranges to remove, overlapping ones included; did: the id (NO_ID if null), th: xxhash64 of the text."""
    return dealt(docs, key, text).groupBy("bucket").applyInArrow(_cover, RANGES)


def dealt(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed rows of SENT: the stretches with a repeated key, by bucket."""
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "suffix")
    rows = _rows(docs, key, text)
    n = C.buckets(spark)
    counted = rows.select("text").mapInArrow(_count_keys(n), COUNTED)
    repeated = scratch.save(counted.groupBy("bucket").applyInArrow(_repeated_keys(HOT), "bucket int, n long, keys binary, hot binary"), "repeated")
    segments = keys_filter(repeated, n, FILTER_BYTES)
    # at most one key for every HOT places of the corpus
    hot = np.sort(np.frombuffer(b"".join(bytes(r["hot"]) for r in repeated.select("hot").filter(F.length("hot") > 0).toLocalIterator()), np.uint64))
    scratch.drop(repeated)
    hot_segments: dict[int, bytes] = {}
    if len(hot):
        windows = rows.select("text").mapInArrow(_count_windows(spark.sparkContext.broadcast(hot), n), KEYED)
        hot_segments = repeated_filter(windows, scratch, n, HOT_FILTER_BYTES)
    sent = spark.sparkContext.broadcast((segments, hot, hot_segments, n))
    return rows.mapInArrow(_send(sent, BUCKETS * n), SENT)


def _apply(docs: DataFrame, key: str, text: str, run, schema: T.StructType) -> DataFrame:
    """Documents with their covered ranges (column ranges), handed to ``run``."""
    ranges = covered_ranges(docs, key, text).groupBy("did", "th").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    t = F.coalesce(F.col(text), F.lit(""))
    marked = docs.withColumns({"__did": F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)), "__th": F.xxhash64(t)})
    ranges = ranges.withColumnsRenamed({"did": "__rdid", "th": "__rth", "ranges": "__ranges"})
    joined = marked.join(ranges, (F.col("__did") == F.col("__rdid")) & (F.col("__th") == F.col("__rth")), "left")
    return joined.select(*docs.columns, "__ranges").mapInArrow(run, schema)


def union(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal covered runs."""
    out: list[list[int]] = []
    for a, b in sorted((r["first"], r["last"]) for r in ranges or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(raw[at:a])
        at = b
    return b"".join([*parts, raw[at:]])


def removals(docs: DataFrame) -> DataFrame:
    """Per document: (doc_id, n_bytes, n_removed, n_spans, kept_sha256).

    Null texts are empty; texts shorter than LENGTH bytes lose nothing.  Equal
    strings of one place (rows that repeat doc_id and text) are one place, not
    repeats of each other; a null doc_id comes before all others."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = T.StructType([T.StructField(n, T.StringType() if n == "kept_sha256" else T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(batch["text"], batch["__ranges"]):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                runs = union(ranges.as_py())
                rows.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_kept(raw, runs)).hexdigest()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c) for c in zip(*rows))] if rows else
                                             [batch["doc_id"], *(pa.array([], f) for f in (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=names)

    return _apply(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", "text", run, schema)


def cut_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the covered bytes cut out of ``text``; every other column stays as it is.

    A character that is covered only in part stays whole, so the text stays
    valid; null texts stay null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, ranges in zip(batch[text], batch["__ranges"]):
                if not value.is_valid or not ranges.is_valid:
                    out.append(value.as_py())
                    continue
                raw = value.as_buffer().to_pybytes()
                runs = []
                for a, b in union(ranges.as_py()):
                    while a < b and raw[a] & 0xC0 == 0x80:  # begins inside a character
                        a += 1
                    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:  # ends inside a character
                        b -= 1
                    if a < b:
                        runs.append((a, b))
                out.append(_kept(raw, runs).decode())
            part = batch.drop_columns(["__ranges"])
            yield part.set_column(part.schema.get_field_index(text), text, pa.array(out, pa.string()))

    return _apply(docs, key, text, run, docs.schema)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removals(C.read(spark, sf_dir, "documents"))


ORACLE = f"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT doc_id, s, substr(h, 2 * s + 1, {2 * LENGTH}) AS g
      FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 - {LENGTH - 1} AS BIGINT))) AS s FROM d)),
f AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS nth FROM w),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + {LENGTH})) AS p FROM f WHERE nth > 1),
r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (fresh) AS n_spans
      FROM (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 1, true) AS fresh FROM c) GROUP BY doc_id),
b AS (SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS x
      FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) // 2 AS BIGINT))) AS p FROM d SEMI JOIN r ON r.doc_id = d.doc_id)),
k AS (SELECT b.doc_id, string_agg(x, '' ORDER BY b.p) AS h FROM b ANTI JOIN c ON c.doc_id = b.doc_id AND c.p = b.p GROUP BY b.doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(CASE WHEN r.doc_id IS NULL THEN d.h ELSE coalesce(k.h, '') END)) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""
