"""N-gram Jaccard self-join with signature trees.

A document is the set of its distinct five-word shingles (64-bit hashes).
Documents with equal sets are one class from the start.  Two classes link when
100 x intersection >= 80 x union.

1. Prefix tokens: linked sets share a token among the first n - ceil(0.8 n) + 1
   of each, in any order that is the same for all.  Tokens that many documents
   hold come last in it, so a passage shared by a third of all documents makes
   no large group unless the documents hold little else.  Tokens of a single
   class are dropped, and of tokens with the same classes one stays: a passage
   that two texts share is one group, not one a token.
2. Chains: within a token's group, neighbours by size are tried first, one
   best partner a document, and verified on the whole sets.  Copies of one
   text are thus connected in linear work.
3. Signature trees: in every group that still holds several components, a tree
   of nodes with OR-combined token bitmaps, size ranges and the component (if
   it is one) is built.  A dual traversal from (root, root) drops a pair of
   nodes whose sizes cannot match, whose bitmaps allow too small an overlap
   (of the sets, or of the prefix tokens: ``prefix_needed``), or whose members
   are connected already.  What is left is verified.
4. Components of the verified links.

Groups beyond ``BLOCK`` members are dealt out as pairs of blocks, so no task
holds a whole hot group; nothing is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from martforge.llm import common as C
from martforge.llm.bloom import KEYED, Filter, bucket_of, keyed_batch, keys_filter, repeated_filter
from martforge.llm.components import components

SHINGLE = 5
PERCENT = 80  # least similarity
BITMAP = 128  # bytes of a signature
FANOUT = 16
BLOCK = 4096
HOT = 100_000  # tokens held back to the end of the order, at most (their choice changes the work, not the result)
OFTEN = 3  # documents of one batch that make a token a candidate for it
PIECE_BYTES = 1 << 20
FILTER_BYTES = 256 << 20
BROADCAST_ROWS = 1_000_000
_STEP = [np.uint64(pow(0xC2B2AE3D27D4EB4F, i + 1, 2**64)) for i in range(SHINGLE)]


# --- sets ------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The sorted set of each text's shingle hashes."""
    starts, ends, border = C.words(data, offsets)
    word = C.span_hashes(data, starts, ends, C.LOWER_HASH)
    rolled = np.zeros(max(0, len(word) - SHINGLE + 1), np.uint64)
    for i, step in enumerate(_STEP):
        rolled += word[i : len(word) - SHINGLE + 1 + i] * step if len(rolled) else rolled
    rolled = C.mix(rolled)
    out = []
    for lo, hi in zip(border[:-1].tolist(), border[1:].tolist()):
        n = hi - lo
        if n >= SHINGLE:
            out.append(np.unique(rolled[lo : hi - SHINGLE + 1]))
        elif n:
            short = np.uint64(n)
            for w, step in zip(word[lo:hi], _STEP):
                short = short * step + w
            out.append(C.mix(np.array([short])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, np.ndarray]]:
    offsets, data = C.text_buffers(batch[column])
    with np.errstate(over="ignore"):
        for lo, hi in C.pieces(offsets, PIECE_BYTES):
            yield from enumerate(shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]), lo)


def print_of(tokens: np.ndarray) -> bytes:
    """128-bit fingerprint of a set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def bitmap(tokens: np.ndarray) -> bytes:
    bits = np.zeros(BITMAP * 8, bool)
    bits[(tokens >> np.uint64(40)).astype(np.int64) % (BITMAP * 8)] = True
    return np.packbits(bits).tobytes()


def prefix(tokens: np.ndarray, hot: np.ndarray, hot_order: np.ndarray) -> np.ndarray:
    """The tokens of which a linked set must share one: the rarest first, then by hash."""
    n = len(tokens)
    keep = n - (PERCENT * n + 99) // 100 + 1
    if not len(hot):
        return tokens[:keep]
    at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
    held = hot[at] == tokens
    if not held.any():
        return tokens[:keep]
    late = tokens[held][np.argsort(hot_order[at[held]], kind="stable")]
    return np.concatenate((tokens[~held], late))[:keep]


def overlap_needed(n, m):
    """Smallest intersection of linked sets of sizes n and m."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_needed(n, m, most):
    """Fewest tokens that linked sets of sizes n and m or larger, but at most ``most``, share inside both prefixes.

    Of i shared tokens after which k - i more follow, the i-th stands among the
    first n - (k - i) of a set, so k - ceil(0.8 most) + 1 of them are in both."""
    return overlap_needed(n, m) - (PERCENT * most + 99) // 100 + 1


def bits_shared(count, bits, other):
    """Most tokens that ``count`` ones with the bitmap ``bits`` can share with those of ``other``: a bit outside is a token of one side only."""
    return count - np.bitwise_count(bits & ~other).sum(axis=1).astype(np.int64)


# --- signature tree ----------------------------------------------------------

class Forest:
    """Signature trees of many groups at once.

    Members are sorted by group and size; FANOUT neighbours of a group share a
    node, level by level, until every group has one root."""

    def __init__(self, group: np.ndarray, size: np.ndarray, bits: np.ndarray, component: np.ndarray, shared: np.ndarray, marks: np.ndarray):
        """``bits``: bitmap of the set; ``shared`` and ``marks``: number and bitmap of its prefix tokens that others hold."""
        ones, marked = (np.bitwise_count(b).sum(axis=1).astype(np.int64) for b in (bits, marks))
        level = {"group": group, "bits": bits, "low": size, "high": size, "ones": ones, "component": component,
                 "shared": shared, "marks": marks, "marked": marked,
                 "first": np.arange(len(group)), "last": np.arange(1, len(group) + 1)}
        self.levels = [level]
        while len(level["group"]) > len(np.unique(level["group"])):
            g = level["group"]
            fresh = np.concatenate(([True], g[1:] != g[:-1]))
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(g)), 0))
            cut = np.flatnonzero((np.arange(len(g)) - start) % FANOUT == 0)
            ends = np.append(cut[1:], len(g))
            low = np.minimum.reduceat(level["component"], cut)
            level = {
                "group": g[cut], "bits": np.bitwise_or.reduceat(level["bits"], cut, axis=0), "low": np.minimum.reduceat(level["low"], cut),
                "high": np.maximum.reduceat(level["high"], cut), "ones": np.minimum.reduceat(level["ones"], cut),
                "shared": np.maximum.reduceat(level["shared"], cut), "marks": np.bitwise_or.reduceat(level["marks"], cut, axis=0),
                "marked": np.minimum.reduceat(level["marked"], cut),
                "component": np.where((low == np.maximum.reduceat(level["component"], cut)) & (low >= 0), low, -1),
                "first": cut, "last": ends}
            self.levels.append(level)

    def _possible(self, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether members of node a and of node b may link and are not connected yet."""
        x = self.levels[depth]
        fine = (x["component"][a] != x["component"][b]) | (x["component"][a] < 0)
        fine &= (100 * x["high"][a] >= PERCENT * x["low"][b]) & (100 * x["high"][b] >= PERCENT * x["low"][a])
        at = np.flatnonzero(fine)
        for part in np.array_split(at, max(1, len(at) // 100_000)):
            i, j = a[part], b[part]
            least = prefix_needed(x["low"][i], x["low"][j], np.maximum(x["high"][i], x["high"][j]))
            fine[part] = (self._most("bits", "ones", "high", depth, i, j) >= overlap_needed(x["low"][i], x["low"][j])) & (
                self._most("marks", "marked", "shared", depth, i, j) >= least)
        return fine

    def _most(self, bits: str, ones: str, count: str, depth: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Most tokens that members of the nodes can share: every bit of a member outside the other node's bitmap is a token that they cannot."""
        x = self.levels[depth]
        common = np.bitwise_count(x[bits][i] & x[bits][j]).sum(axis=1).astype(np.int64)
        return np.minimum(x[count][i] - np.maximum(0, x[ones][i] - common), x[count][j] - np.maximum(0, x[ones][j] - common))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of members that survive the dual traversal."""
        roots = np.arange(len(self.levels[-1]["group"]))
        stack = [(len(self.levels) - 1, roots, roots)]
        while stack:
            depth, a, b = stack.pop()
            if len(a) > 200_000:
                half = len(a) // 2
                stack += [(depth, a[:half], b[:half]), (depth, a[half:], b[half:])]
                continue
            fine = self._possible(depth, a, b) if depth else self._possible(depth, a, b) & (a != b)
            a, b = a[fine], b[fine]
            if not len(a):
                continue
            if depth == 0:
                yield a, b
                continue
            x = self.levels[depth]
            first, wide = x["first"], x["last"] - x["first"]
            many = wide[a] * wide[b]
            which = np.repeat(np.arange(len(a)), many)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
            i, j = first[a[which]] + nth // wide[b[which]], first[b[which]] + nth % wide[b[which]]
            once = (a[which] != b[which]) | (i <= j)
            stack.append((depth - 1, i[once], j[once]))


def _tree_pairs(table: pa.Table) -> pa.Table:
    """Candidate pairs of one bucket of (cell, side, fp, n, sig, shared, mark, component)."""
    cell = np.unique(np.array(table["cell"].to_pylist(), object).astype(str), return_inverse=True)[1]
    prints = np.array(table["fp"].to_pylist(), object)
    size = table["n"].to_numpy().astype(np.int64)
    component = np.unique(np.array([bytes(c) for c in table["component"].to_pylist()], object), return_inverse=True)[1]
    order = np.lexsort((component, size, cell))
    bits, marks = (np.frombuffer(b"".join(table[c].to_pylist()), np.uint64).reshape(-1, BITMAP // 8)[order] for c in ("sig", "mark"))
    side = table["side"].to_numpy()[order]
    prints = prints[order]
    forest = Forest(cell[order], size[order], bits, component[order], table["shared"].to_numpy().astype(np.int64)[order], marks)
    found = set()
    for a, b in forest.pairs():
        other = (side[a] == 0) | (side[b] == 0) | (side[a] != side[b])  # two blocks: only pairs across
        for x, y in zip(prints[a[other]], prints[b[other]]):
            if x != y:
                found.add((x, y) if x < y else (y, x))
    u, v = zip(*sorted(found)) if found else ((), ())
    return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})


# --- distributed steps ---------------------------------------------------------

def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen, parts = set(), []
        for _, tokens in _sets(batch):
            mark = print_of(tokens)
            if mark not in seen:
                seen.add(mark)
                parts.append(tokens)
        keys, counts = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        many = counts >= OFTEN
        yield pa.RecordBatch.from_arrays([pa.array(keys[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], names=["token", "n"])


def _describe(hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ranks = hot.value
        for batch in batches:
            rows = [(print_of(s), len(s), bitmap(s), prefix(s, tokens, ranks).tobytes()) for _, s in _sets(batch)]
            fp, n, sig, pre = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["th"], pa.array(fp, pa.binary()), pa.array(n, pa.int64()),
                                              pa.array(sig, pa.binary()), pa.array(pre, pa.binary())], names=["doc_id", "th", "fp", "n", "sig", "pre"])
    return run


def _emit_tokens(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = np.frombuffer(b"".join(batch["pre"].to_pylist()), np.uint64)
            if len(tokens):
                yield keyed_batch(tokens, n_buckets)
    return run


def _held_by_others(batch: pa.RecordBatch, sent) -> tuple[np.ndarray, np.ndarray]:
    """The prefix tokens that several classes hold, and the row of each."""
    bloom, n_buckets = sent.value
    size = np.array([len(p) // 8 for p in batch["pre"].to_pylist()], np.int64)
    tokens = np.frombuffer(b"".join(batch["pre"].to_pylist()), np.uint64)
    fine = bloom.level(tokens, bucket_of(tokens, n_buckets), 1) > 0
    return tokens[fine], np.repeat(np.arange(len(size)), size)[fine]


def _postings(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, owner = _held_by_others(batch, sent)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), batch["fp"].take(at), batch["n"].take(at)], names=["token", "fp", "n"])
    return run


def _marks(sent):
    """Of each class: number and bitmap of its prefix tokens that others hold; classes without one are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, owner = _held_by_others(batch, sent)
            rows, cuts = np.unique(owner, return_index=True)
            mark = [bitmap(t) for t in np.split(tokens, cuts[1:])] if len(rows) else []
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c].take(at) for c in ("fp", "n", "sig")), pa.array(np.diff(np.append(cuts, len(tokens))), pa.int64()), pa.array(mark, pa.binary())],
                names=["fp", "n", "sig", "shared", "mark"])
    return run


def _wanted_sets(sent):
    """(fp, tokens) of the texts whose set is wanted, once a task, in pieces of ``PIECE_BYTES``: what a task holds of them is bounded by bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, n_buckets = sent.value
        gone: set[bytes] = set()  # marks of this task's split
        for batch in batches:
            found: dict[bytes, bytes] = {}
            held = 0
            for _, tokens in _sets(batch):
                mark = print_of(tokens)
                if mark not in gone:
                    gone.add(mark)
                    key = np.frombuffer(mark[:8], np.uint64)
                    if bloom.level(key, bucket_of(key, n_buckets), 1)[0]:
                        found[mark] = tokens.tobytes()
                        held += len(found[mark])
                if held > PIECE_BYTES:
                    yield _set_batch(found)
                    found, held = {}, 0
            if found:
                yield _set_batch(found)
    return run


def _set_batch(found: dict[bytes, bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], names=["fp", "tokens"])


def _print_keys(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([int.from_bytes(p[:8], "little") for p in batch["fp"].to_pylist()], np.uint64)
            for b in np.unique(bucket_of(keys, n_buckets)).tolist():
                mine = np.unique(keys[bucket_of(keys, n_buckets) == b])
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([len(mine)], pa.int64()), pa.array([C.blob(mine)], pa.binary())],
                                                 names=["bucket", "n", "keys"])
    return run


def _views(sets: pa.Table) -> dict[bytes, np.ndarray]:
    """Each set by its mark, as a view of the table's own buffers: the sets are not copied."""
    found: dict[bytes, np.ndarray] = {}
    for chunk in sets.to_batches():
        offsets, data = C.text_buffers(chunk.column("tokens"))
        for i, mark in enumerate(chunk.column("fp").to_pylist()):
            found[mark] = data[offsets[i] : offsets[i + 1]].view(np.uint64)
    return found


def _linked(key: tuple, sets: pa.Table, pairs: pa.Table) -> pa.Table:
    """Links of one bucket's pairs.  A pair that earlier links connect already is not looked at."""
    tokens = _views(sets)
    root: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    found = []
    for u, v, cu, cv in sorted(zip(*(pairs[c].to_pylist() for c in ("u", "v", "cu", "cv")))):
        if find(cu) == find(cv):
            continue
        x, y = tokens[u], tokens[v]
        both = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * both >= PERCENT * (len(x) + len(y) - both):
            root[find(cu)] = find(cv)
            found.append((u, v))
    u, v = zip(*found) if found else ((), ())
    return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})


def _verify(pairs: DataFrame, labels: DataFrame | None, rows: DataFrame, scratch: C.Scratch, n_buckets: int) -> DataFrame:
    """Links among the pairs (u, v), on the whole sets: enough of them to connect what the pairs' links connect.

    Pairs are grouped by the clusters that they make up, so a set travels once
    to its cluster (to each pair of blocks, if the cluster is large), not once
    a pair.  labels: components known already."""
    spark = rows.sparkSession
    clusters = scratch.save(components(pairs, scratch), "clusters")
    wanted = keys_filter(clusters.select(F.col("node").alias("fp")).mapInArrow(_print_keys(n_buckets), "bucket int, n long, keys binary"),
                         n_buckets, FILTER_BYTES)
    if not wanted:
        return pairs.limit(0)
    blocks = clusters.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = clusters.join(blocks, "component").select(
        F.col("node").alias("fp"), "component", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    placed = scratch.save(placed, "placed")

    def bucket(low, high):
        return F.pmod(F.xxhash64("component", low, high), F.lit(n_buckets)).cast("int").alias("bucket")

    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = spread.select("fp", bucket(F.least("block", "other"), F.greatest("block", "other"))).distinct()
    sent = spark.sparkContext.broadcast((Filter(wanted, n_buckets), n_buckets))
    sets = rows.select("text").mapInArrow(_wanted_sets(sent), "fp binary, tokens binary").join(C.small(scratch.save(dealt, "dealt"), BROADCAST_ROWS), "fp")
    end = lambda e, block: placed.select(F.col("fp").alias(e), F.col("block").alias(block), *(["component"] if e == "u" else []))
    aimed = pairs.join(end("u", "bu"), "u").join(end("v", "bv"), "v").select("u", "v", bucket(F.least("bu", "bv"), F.greatest("bu", "bv")))
    for e in ("u", "v"):
        if labels is None:
            aimed = aimed.withColumn(f"c{e}", F.col(e))
        else:
            known = labels.select(F.col("node").alias(e), F.col("component").alias(f"c{e}"))
            aimed = aimed.join(known, e, "left").withColumn(f"c{e}", F.coalesce(f"c{e}", e))
    grouped = sets.groupBy("bucket").cogroup(aimed.select("bucket", "u", "v", "cu", "cv").groupBy("bucket"))
    out = scratch.save(grouped.applyInArrow(_linked, "u binary, v binary"), "links")
    scratch.drop(clusters, placed)
    return out


def _one_of_equal_groups(postings: DataFrame) -> DataFrame:
    """(token, fp, n, df, weight): of the groups with the same members one, the smallest token's; weight: their number.

    Members are compared by their number and a 128-bit sum of their hashes."""
    half = lambda h: [F.sum(F.shiftrightunsigned(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    sums = [s.alias(f"s{i}") for i, s in enumerate([*half(F.xxhash64("fp")), *half(F.xxhash64("fp", F.lit(1)))])]
    groups = postings.groupBy("token").agg(F.count("*").alias("df"), *sums).filter("df > 1")
    kept = groups.groupBy("df", "s0", "s1", "s2", "s3").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    return postings.join(kept.select("token", "df", "weight"), "token")


def _chains(postings: DataFrame, classes: DataFrame) -> DataFrame:
    """For each class its best partners over its groups (large groups in salted parts): the neighbour before and the one
    after it in order of size, and the pivot, the member whose tokens are shared most (the text that others are copies of)."""
    shared = classes.select("fp", (F.col("shared") / F.col("n")).alias("shared"))
    salt = F.pmod(F.xxhash64("fp", "token"), F.ceil(F.col("df") / BLOCK))
    order = Window.partitionBy("token", "salt").orderBy("n", "fp")
    members = postings.join(shared, "fp").withColumn("salt", salt)
    pivot = Window.partitionBy("token", "salt").orderBy(F.desc("shared"), "fp")
    beside = (members.withColumn("u", F.lag("fp").over(order)).withColumn("m", F.lag("n").over(order))
              .filter(F.col("u").isNotNull() & (100 * F.col("m") >= PERCENT * F.col("n"))))
    under = (members.withColumn("u", F.first("fp").over(pivot)).withColumn("m", F.first("n").over(pivot))
             .filter((F.col("u") != F.col("fp")) & (100 * F.least("m", "n") >= PERCENT * F.greatest("m", "n"))))
    count = lambda found: found.groupBy("u", F.col("fp").alias("v")).agg(F.sum("weight").alias("votes"))
    best = lambda counted, own, other: counted.groupBy(own).agg(F.max(F.struct("votes", other)).alias("b")).select(
        F.col(own).alias("x"), F.col(f"b.{other}").alias("y"))
    beside, under = count(beside), count(under)
    return best(beside, "u", "v").union(best(beside, "v", "u")).union(best(under, "v", "u")).select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")).distinct()


def _fits(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sizes and bitmaps allow a link."""
    own = {"n": "n", "sig": "s", "shared": "h", "mark": "k"}
    side = lambda end, e: classes.select(F.col("fp").alias(end), *[F.col(c).alias(short + e) for c, short in own.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, k, l = (np.frombuffer(b"".join(batch[s].to_pylist()), np.uint64).reshape(-1, BITMAP // 8) for s in ("sa", "sb", "ka", "kb"))
            n, m, h, g = (batch[c].to_numpy() for c in ("na", "nb", "ha", "hb"))
            fine = np.minimum(bits_shared(n, a, b), bits_shared(m, b, a)) >= overlap_needed(n, m)
            fine &= np.minimum(bits_shared(h, k, l), bits_shared(g, l, k)) >= prefix_needed(n, m, np.maximum(n, m))
            yield batch.select(["u", "v"]).filter(pa.array(fine))

    both = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v")
    return both.select("u", "v", *[short + e for e in "ab" for short in own.values()]).mapInArrow(run, "u binary, v binary")


def _cells(postings: DataFrame, classes: DataFrame, joined: DataFrame, n_buckets: int) -> DataFrame:
    """Members of the groups with several components, by cell: a group, or a pair of blocks of a large one."""
    labelled = postings.join(joined.withColumnsRenamed({"node": "fp"}), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    mixed = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    members = labelled.join(mixed.select("token"), "token").join(classes.select("fp", "sig", "shared", "mark"), "fp")
    blocks = F.ceil(F.col("df") / BLOCK)
    block = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    dealt = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    cell = F.concat_ws(":", "token", low, high)
    return dealt.select(
        F.pmod(F.xxhash64(cell), F.lit(n_buckets)).cast("int").alias("bucket"), cell.alias("cell"),
        F.when(low == high, 0).when(F.col("block") == low, 1).otherwise(2).alias("side"), "fp", "n", "sig", "shared", "mark", "component")


def classes_of(docs: DataFrame) -> DataFrame:
    """Per document row: (doc_id, th, n, component); component: a fingerprint that linked rows share, th: xxhash64 of the text."""
    spark = docs.sparkSession
    C.lean_batches(spark)
    scratch = C.Scratch(spark, "jaccard")
    n_buckets = C.buckets(spark)
    rows = C.texts(docs).withColumn("th", F.xxhash64("text"))
    often = (rows.select("text").mapInArrow(_often, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "token").limit(HOT).select("token").toPandas())
    tokens = often["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    ranks = np.arange(len(tokens))[::-1][order]  # the most frequent comes last of all
    described = scratch.save(rows.mapInArrow(_describe(spark.sparkContext.broadcast((tokens[order], ranks))),
                                             "doc_id long, th long, fp binary, n long, sig binary, pre binary"), "sets")
    lead = F.min(F.struct("doc_id", "th")).alias("lead")  # one row of each class stands for it
    leads = described.filter("n > 0").groupBy("fp").agg(lead).select("fp", F.col("lead.doc_id").alias("d"), F.col("lead.th").alias("t"))
    leads = scratch.save(leads, "leads")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))
    small = leads.count() <= BROADCAST_ROWS
    classes = described.join(F.broadcast(leads) if small else leads, "fp").filter(same).select("fp", "n", "sig", "pre")
    if not small:  # a shuffle join, so done once
        classes = scratch.save(classes, "classes")
    repeated = repeated_filter(classes.select("pre").mapInArrow(_emit_tokens(n_buckets), KEYED), scratch, n_buckets, FILTER_BYTES)
    sent = spark.sparkContext.broadcast((Filter(repeated, n_buckets), n_buckets))
    classes, whole = (scratch.save(classes.select("fp", "n", "sig", "pre").mapInArrow(_marks(sent), "fp binary, n long, sig binary, shared long, mark binary"), "marks"),
                      scratch.save(classes.select("fp", "n", "pre").mapInArrow(_postings(sent), "token long, fp binary, n long"), "postings"))
    postings = scratch.save(_one_of_equal_groups(whole), "groups")
    scratch.drop(whole)
    links = _verify(scratch.save(_fits(_chains(postings, classes), classes), "chains"), None, rows, scratch, n_buckets)
    joined = scratch.save(components(links, scratch), "joined")
    cells = _cells(postings, classes, joined, n_buckets)
    candidates = scratch.save(cells.groupBy("bucket").applyInArrow(_tree_pairs, "u binary, v binary").distinct(), "candidates")
    more = _verify(candidates, joined, rows, scratch, n_buckets)
    final = scratch.save(components(links.union(more), scratch), "components")
    scratch.drop(postings, candidates, joined)
    return (described.select("doc_id", "th", "fp", "n").join(final.withColumnsRenamed({"node": "fp"}), "fp", "left")
            .select("doc_id", "th", "n", F.coalesce("component", "fp").alias("component")))


def link_components(docs: DataFrame) -> DataFrame:
    """Per document row: (doc_id, n_shingles, component_id).

    Null and empty texts have no shingles and are linked with nothing (their
    component is their own id); rows that repeat a doc_id count each by its
    own text; a component of null ids only has a null id."""
    rows = classes_of(docs)
    least = rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, of each component the one with the smallest doc_id (null ids last, then the smaller text hash).

    Documents without shingles all stay, but rows that repeat both doc_id and
    text are one document.  Every column stays."""
    last, keys = F.lit((1 << 63) - 1), ["__id", "__th"]
    scratch = C.Scratch(docs.sparkSession, "keep")
    rows = scratch.save(classes_of(docs).select(F.coalesce("doc_id", last).alias("__id"), F.col("th").alias("__th"), "n", "component"), "rows")
    leads = rows.filter("n > 0").groupBy("component").agg(F.min(F.struct(*keys)).alias("lead")).select("lead.*")
    kept = scratch.save(leads.union(rows.filter("n = 0").select(*keys)), "kept")
    again = scratch.save(rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys), "again")
    marked = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), last), "__th": F.xxhash64(F.coalesce("text", F.lit("")))})
    found = marked.join(C.small(kept), keys, "left_semi")
    if not again.isEmpty():  # only rows that repeat both keys are shuffled to leave one of them
        repeats = C.small(again)
        found = found.join(repeats, keys, "left_anti").union(found.join(repeats, keys, "left_semi").dropDuplicates(keys))
    return found.select(*docs.columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(C.read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') || CASE WHEN len(w) < 5 THEN ' ' ELSE '' END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
l AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.v, r.c FROM r JOIN l ON l.u = r.doc_id AND r.c < l.v)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.c) AS component_id
FROM d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL
"""
