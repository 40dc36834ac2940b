"""Ranked lexical search by exact inner products over ball trees of sparse vectors.

An item's score for a document is an inner product: term weights times term
impacts, all integers.  Items are taken in blocks of bounded vocabulary:

1. One pass over the texts keeps, for each document, its length and the counts
   of the block's terms (no other term can add to a score), and adds up N, L
   and the document frequencies, per task first.
2. Documents are dealt by range of their heaviest terms, then by id, so that
   neighbours share a task and no key is hot.
3. Documents are scored for the items that own one of their heaviest terms.  The
   tenth best of these scores is a floor: the item's tenth best is no lower.
4. Each task takes its documents in chunks of bounded size and builds a ball
   tree over each, splitting a node at two far members.  A node is a centroid
   and a radius in each of a few orthogonal subspaces of the vocabulary (the
   terms that only one item has; every shared term by itself), so that terms
   of other items don't widen the balls that an item meets.  ``q.c + |q| r``,
   added up over the subspaces, bounds the score of every document below.  An
   item's nodes are opened best first; a subtree goes when its bound, rounded
   up, is below the item's tenth best score so far; leaves are scored exactly,
   in 64-bit integers.
5. The best ten of each task and item are ranked once more.

The space is scaled by the square root of the weights (impacts up, weights
down), which leaves inner products as they are.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from martforge.llm import words as W
from martforge.llm.common import Scratch, buckets, read

TOP = 10
#: bytes of the term rule, once A-Z are lower case
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: a block of items: as many as stay under these numbers of items, of distinct terms and of item terms
BLOCK_ITEMS, BLOCK_TERMS, BLOCK_POSTINGS = 1000, 16_384, 200_000
#: a chunk of documents, the entries of their vectors, and the numbers in the centroids of its tree (64 MB)
CHUNK_DOCS, CHUNK_ENTRIES, CHUNK_CENTROIDS = 4096, 1_000_000, 1 << 23
LEAF = 64
#: a text beyond this is counted term by term instead of through a list of its terms
LONG_TEXT = 1 << 20
#: terms that place a document in the range of its task
KEY_TERMS = 4
OUT = "item_id long, rank int, doc_id long, score long"
DOC, STAT = 0, 1


@dataclass
class Block:
    """Items with their terms, as numbers into the block's vocabulary."""

    items: list[int | None] = field(default_factory=list)
    terms: list[np.ndarray] = field(default_factory=list)
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    postings: int = 0

    def add(self, item: int | None, terms: list[str]) -> None:
        number = [self.vocabulary.setdefault(t.encode(), len(self.vocabulary)) for t in sorted(terms)]
        self.items.append(item)
        self.terms.append(np.array(number, np.int64))
        self.postings += len(number)


def blocks(items: DataFrame, text: str, key: str) -> Iterator[Block]:
    """Blocks of items, in id order; the rows of an id are one item, its terms once each."""
    words = items.select(F.col(key).cast("long").alias("item_id"), F.explode(W.alnum_words(F.coalesce(F.col(text), F.lit("")))).alias("term")).distinct()
    rows = words.groupBy("item_id").agg(F.collect_list("term").alias("terms")).orderBy("item_id")
    block = Block()
    for r in rows.toLocalIterator():
        if block.items and (len(block.items) >= BLOCK_ITEMS or len(block.vocabulary) + len(r["terms"]) > BLOCK_TERMS or block.postings + len(r["terms"]) > BLOCK_POSTINGS):
            yield block
            block = Block()
        block.add(r["item_id"], r["terms"])
    if block.items:
        yield block


# --- pass over the texts ---------------------------------------------------

def _count(raw: bytes) -> Counter:
    low = raw.lower()  # bytes: A-Z only
    return Counter(TERM.findall(low) if len(low) <= LONG_TEXT else (m[0] for m in TERM.finditer(low)))


def _vectors(vocabulary: dict[bytes, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents with a term of the block: (DOC, doc_id, n, term numbers, counts); at the end (STAT, term, df)."""
        df = np.zeros(len(vocabulary), np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            out: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw")):
                counts = _count(raw.as_py())
                n = counts.total()
                if not n:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + n
                found = sorted((vocabulary[t], c) for t, c in counts.items() if t in vocabulary)
                if found:
                    at, tf = np.array(found, np.int64).T
                    df[at] += 1
                    for column, value in zip(out, (doc_id, n, at.astype(np.int32).tobytes(), tf.astype(np.int32).tobytes())):
                        column.append(value)
            if out[0]:
                yield _rows(DOC, *out)
        seen = np.flatnonzero(df)
        yield _rows(STAT, [-1, -2, *seen.tolist()], [n_docs, n_terms, *df[seen].tolist()], [b""] * (2 + len(seen)), [b""] * (2 + len(seen)))
    return run


def _rows(kind: int, key: list, n: list, at: list, tf: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind] * len(key), pa.int32()), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
                                       pa.array(at, pa.binary()), pa.array(tf, pa.binary())], names=["kind", "doc_id", "n", "at", "tf"])


@dataclass
class Scoring:
    """The integer scoring rule of one block."""

    n_docs: int
    n_terms: int
    weights: np.ndarray  # int64, by term number

    @classmethod
    def of(cls, stats: dict[int, int], size: int) -> "Scoring":
        n = stats.get(-1, 0)
        weigh = lambda df: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
        return cls(n, stats.get(-2, 0), np.array([weigh(stats.get(t, 0)) for t in range(size)], np.int64))

    def impacts(self, n: int, tf: np.ndarray) -> np.ndarray:
        m = 100 - 90 + (90 * n * self.n_docs) // self.n_terms
        tf = tf.astype(np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _place(scoring: Scoring) -> Callable:
    order = np.argsort(np.argsort(-scoring.weights, kind="stable")).astype(">i4")  # 0: the heaviest term

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(place, doc_id, at, impact): the numbers of a document's heaviest terms, in one sortable value."""
        for batch in batches:
            place, impact = [], []
            for n, at, tf in zip(batch.column("n").to_pylist(), batch.column("at").to_pylist(), batch.column("tf").to_pylist()):
                place.append(np.sort(order[np.frombuffer(at, np.int32)])[:KEY_TERMS].astype(">i4").tobytes())
                impact.append(scoring.impacts(n, np.frombuffer(tf, np.int32)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.binary()), batch.column("doc_id"), batch.column("at"), pa.array(impact, pa.binary())],
                                             names=["place", "doc_id", "at", "impact"])
    return run


# --- the tree --------------------------------------------------------------

class Sparse:
    """Rows of (term number, impact) and of the scaled values, in flat arrays."""

    def __init__(self, at: list[bytes], impact: list[bytes], scale: np.ndarray):
        self.size = np.array([len(a) // 4 for a in at], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.at = np.frombuffer(b"".join(at), np.int32)
        self.impact = np.frombuffer(b"".join(impact), np.int64)
        self.value = self.impact * scale[self.at]
        self.square = np.add.reduceat(self.value * self.value, self.start[:-1])

    def flat(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the entries of the rows, first entry of each row among them); every row has an entry."""
        size = self.size[rows]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        return np.arange(size.sum()) + np.repeat(self.start[rows] - first, size), first


def chunk_docs(terms: int) -> int:
    """Documents of a chunk: no leaf of theirs is below a quarter of ``LEAF``, which bounds the nodes and so the centroids."""
    return max(LEAF, min(CHUNK_DOCS, CHUNK_CENTROIDS * LEAF // (8 * max(1, terms))))


class Space:
    """The block's vocabulary as orthogonal subspaces, and its scale.

    A term that several items share is a subspace of its own; the terms that
    only one item has are that item's subspace."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray):
        self.weights = weights
        self.scale = np.sqrt(weights.astype(np.float64))
        self.items = [t[weights[t] > 0] for t in terms]  # a weight of 0 adds nothing
        owner = np.full(len(weights), -1, np.int64)
        for item, t in enumerate(self.items):
            owner[t] = np.where(owner[t] == -1, item, -2)
        self.owner = np.maximum(owner, -1)  # -1: shared, or nobody's
        self.own = self.owner >= 0


class Tree:
    """Nodes by number, the root 0: children (-1: a leaf) and the rows of leaves.

    A node is a ball in every subspace.  ``ends`` holds the far end of the ball
    for the one-term subspaces (an interval: centre plus radius is its largest
    value) and the centroid for the others, ``radii`` the radius in each item's
    subspace.  Radii are rounded up."""

    def __init__(self, rows: Sparse, space: Space):
        self.rows, self.space = rows, space
        self.children: list[tuple[int, int]] = []
        self.members: list[np.ndarray] = []
        ends, radii = [], []
        todo = [(np.arange(len(rows.size)), -1, 0)]
        while todo:
            some, parent, side = todo.pop()
            here = len(ends)
            if parent >= 0:
                pair = list(self.children[parent])
                pair[side] = here
                self.children[parent] = (pair[0], pair[1])
            places, first = rows.flat(some)
            at, value = rows.at[places], rows.value[places]
            centre = np.bincount(at, value, len(space.weights)) / len(some)
            far = np.zeros(len(centre))
            np.maximum.at(far, at, value)
            ends.append(np.where(space.own, centre, far))
            radii.append(self._radii(centre, at, value, first))
            self.children.append((-1, -1))
            self.members.append(some)
            if len(some) > LEAF:
                halves = self._split(some, centre, at, value, first)
                if halves is not None:
                    self.members[here] = some[:0]
                    todo += [(halves[0], here, 0), (halves[1], here, 1)]
        self.ends, self.radii = np.stack(ends), np.stack(radii)

    def _radii(self, centre: np.ndarray, at: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest distance to the centroid in each item's subspace: |c|^2 + sum of d^2 - 2dc over a row's terms there."""
        space, n = self.space, len(self.space.items)
        square = np.bincount(space.owner[space.own], centre[space.own] ** 2, n) if n else np.zeros(0)
        mine = np.flatnonzero(space.own[at])
        row = np.searchsorted(first, mine, "right") - 1
        key, place = np.unique(row * n + space.owner[at[mine]], return_inverse=True)
        v, c = value[mine], centre[at[mine]]
        gain, size = np.bincount(place, v * v - 2 * v * c, len(key)), np.bincount(place, v * v + 2 * v * c, len(key))
        most, widest = np.zeros(n), np.zeros(n)
        np.maximum.at(most, key % n, gain)
        np.maximum.at(widest, key % n, size)
        return np.sqrt(square + most + 1e-11 * (square + widest)) * (1 + 1e-9)  # the sums' error is far less than what is added

    def _split(self, some: np.ndarray, centre: np.ndarray, at: np.ndarray, value: np.ndarray, first: np.ndarray):
        """Rows nearer to one of two far members (at least a quarter a side), or the two halves of the dealt order,
        whichever leaves less spread around its two centroids; equal rows stay in one leaf."""
        ends = np.append(first[1:], len(at))
        own = self.rows.square[some]

        def apart(point: np.ndarray) -> np.ndarray:
            return np.maximum(own - 2 * np.add.reduceat(value * point[at], first) + float(point @ point), 0)

        def member(k: int) -> np.ndarray:
            point = np.zeros(len(centre))
            point[at[first[k] : ends[k]]] = value[first[k] : ends[k]]
            return point

        def closeness(side: np.ndarray) -> float:
            """What the spread around the two centroids falls short of the rows' own squares."""
            total = 0.0
            for rows in (side, ~side):
                entries = np.repeat(rows, ends - first)
                mean = np.bincount(at[entries], value[entries], len(centre)) / rows.sum()
                total += float(rows.sum()) * float(mean @ mean)
            return total

        one = apart(member(int(apart(centre).argmax())))
        other = int(one.argmax())
        if one[other] <= 1e-9 * float(own.max()):
            return None  # copies
        lean = one - apart(member(other))
        near = lean > 0
        if not len(some) <= 4 * near.sum() <= 3 * len(some):  # a few outliers on one side: halves by the same order, so that trees stay low
            near = np.zeros(len(some), bool)
            near[np.argsort(lean, kind="stable")[len(some) // 2 :]] = True
        halves = np.arange(len(some)) < len(some) // 2
        side = halves if closeness(halves) >= closeness(near) else near
        return some[side], some[~side]

    def bounds(self, item: int) -> np.ndarray:
        """For every node a number that no row below it scores above: q.c + |q| r in each subspace, added up and rounded up."""
        terms = self.space.items[item]
        q = self.space.scale[terms]  # weight / scale
        own = q[self.space.own[terms]]
        return (self.ends[:, terms] @ q + math.sqrt(float(own @ own)) * self.radii[:, item]) * (1 + 1e-9) + 1


class Search:
    """The best rows of every item of a block over the chunks that are given to it.

    ``floor``: scores that ``top`` documents are known to reach; lower ones are not looked for."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, top: int, floor: np.ndarray | None = None):
        self.space, self.top = Space(terms, weights), top
        self.floor = np.ones(len(terms), np.int64) if floor is None else np.maximum(floor, 1)
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in terms]
        self.scored = 0

    def add(self, ids: list[int | None], at: list[bytes], impact: list[bytes]) -> None:
        rows = Sparse(at, impact, self.space.scale)
        tree = Tree(rows, self.space)
        dense = np.zeros(len(self.space.weights), np.int64)
        for item, terms in enumerate(self.space.items):
            if len(terms):
                dense[terms] = self.space.weights[terms]
                self._walk(item, ids, tree, tree.bounds(item).tolist(), dense)
                dense[terms] = 0

    def _least(self, item: int) -> int:
        best = self.best[item]
        return max(int(self.floor[item]), best[0][0] if len(best) == self.top else 0)

    def _walk(self, item: int, ids: list, tree: Tree, bound: list[float], dense: np.ndarray) -> None:
        best, rows, least = self.best[item], tree.rows, self._least(item)
        heap = [(-bound[0], 0)]
        while heap:
            high, node = heapq.heappop(heap)
            if -high < least:
                return
            left, right = tree.children[node]
            if left >= 0:
                for child in (left, right):
                    if bound[child] >= least:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            some = tree.members[node]
            places, first = rows.flat(some)
            score = np.add.reduceat(dense[rows.at[places]] * rows.impact[places], first)
            self.scored += len(some)
            for k in np.flatnonzero(score >= least):
                doc = ids[some[k]]
                entry = (int(score[k]), int(doc is not None), -(doc or 0))  # ties: smaller ids are better, null ids last
                if len(best) < self.top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            least = self._least(item)


def _seeds(terms: list[np.ndarray], weights: np.ndarray, top: int) -> Callable:
    """Exact scores of documents for the items that own one of their heaviest terms: (item, score), the best of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space(terms, weights)
        dense = {}
        best: list[list[int]] = [[] for _ in terms]
        for batch in batches:
            for at, impact in zip(batch.column("at").to_pylist(), batch.column("impact").to_pylist()):
                number = np.frombuffer(at, np.int32)
                own = number[space.own[number]]
                for item in {int(i) for i in space.owner[own[np.argsort(-weights[own], kind="stable")[:KEY_TERMS]]]}:
                    if item not in dense:
                        if len(dense) > 500:
                            dense.clear()
                        dense[item] = np.zeros(len(weights), np.int64)
                        dense[item][terms[item]] = weights[terms[item]]
                    score = int((dense[item][number] * np.frombuffer(impact, np.int64)).sum())
                    if len(best[item]) < top:
                        heapq.heappush(best[item], score)
                    elif score > best[item][0]:
                        heapq.heapreplace(best[item], score)
        rows = [(i, v) for i, some in enumerate(best) for v in some]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())], names=["item", "score"])
    return run


def _search(terms: list[np.ndarray], weights: np.ndarray, top: int, floor: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(terms, weights, top, floor)
        held: tuple[list, list, list] = ([], [], [])
        entries, limit = 0, chunk_docs(len(weights))

        def flush() -> None:
            if held[0]:
                search.add(*held)
                for column in held:
                    column.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at", "impact"))):
                for column, value in zip(held, row):
                    column.append(value)
                entries += len(row[1]) // 4
                if len(held[0]) >= limit or entries >= CHUNK_ENTRIES:
                    flush()
                    entries = 0
        flush()
        out = [(i, -b[2] if b[1] else None, b[0]) for i, best in enumerate(search.best) for b in best]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
                                              pa.array([r[2] for r in out], pa.int64())], names=["item", "doc_id", "score"])
    return run


def _floor(placed: DataFrame, block: Block, scoring: Scoring, top: int) -> np.ndarray:
    """Per item a score that ``top`` documents reach (0: not known), from exact scores of likely documents."""
    seeds = placed.select("at", "impact").mapInArrow(_seeds(block.terms, scoring.weights, top), "item int, score long")
    w = Window.partitionBy("item").orderBy(F.desc("score"))
    least = seeds.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") == top).select("item", "score")
    floor = np.zeros(len(block.items), np.int64)
    for r in least.collect():  # at most one row an item of the block
        floor[r["item"]] = r["score"]
    return floor


def search(docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text", key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """Per item its ``top`` documents with a score above 0: (item_id, rank, doc_id, score).

    * null and empty texts have no terms: such documents are not counted in N and
      score nothing, such items have no rows;
    * equal scores rank by ascending doc_id, null ids last; rows that repeat a
      doc_id are documents of their own;
    * rows that repeat an item_id are one item with all their terms; a null
      item_id is an item;
    * further columns are not read; an empty table gives an empty result."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "ball-tree")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("raw"))
    found: list[DataFrame] = []
    for block in blocks(items, text, item_key):
        rows = scratch.save(texts.mapInArrow(_vectors(block.vocabulary), "kind int, doc_id long, n long, at binary, tf binary"), "vectors")
        stats = rows.filter(F.col("kind") == STAT).groupBy("doc_id").agg(F.sum("n").alias("n")).collect()  # at most BLOCK_TERMS + 2 rows
        scoring = Scoring.of({r["doc_id"]: r["n"] for r in stats}, len(block.vocabulary))
        placed = rows.filter(F.col("kind") == DOC).select("doc_id", "n", "at", "tf").mapInArrow(_place(scoring), "place binary, doc_id long, at binary, impact binary")
        dealt = placed.repartitionByRange(buckets(spark), "place", "doc_id").sortWithinPartitions("place", "doc_id")
        floor = _floor(placed, block, scoring, top)
        best = dealt.select("doc_id", "at", "impact").mapInArrow(_search(block.terms, scoring.weights, top, floor), "item int, doc_id long, score long")
        w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(block.items)), "item int, item_id long")  # the items of one block
        found.append(scratch.save(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
        scratch.drop(rows)
    if not found:
        return spark.createDataFrame([], OUT)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY doc_id, n, term),
q AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
v AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)) AS impact FROM t, s),
r AS (SELECT item_id, doc_id, CAST(sum(w * impact) AS BIGINT) AS score FROM i JOIN v ON i.term = v.term JOIN q ON q.term = v.term
      GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 10
"""
