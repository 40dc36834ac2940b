"""Ranked search against plain scoring of every document, and the tree's bounds against exact scores."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from martforge.llm import ball_tree
from tests.llm.conftest import got

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    counts = [(i, Counter(_terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        for rank, (s, no_id, doc) in enumerate(sorted(scores)[:top]):
            out.append((item, rank + 1, None if no_id else doc, -s))
    return sorted(out, key=lambda r: tuple((x is not None, str(type(x)), x) for x in r))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    common = ["the", "of", "Émile", "and", "x1"]
    words = ["".join(rng.choice("abcdeö") for _ in range(4)) for _ in range(400)]
    text = lambda: " ".join(rng.choice(common) if rng.random() < 0.5 else rng.choice(words).title() for _ in range(rng.randint(1, 60)))
    docs = [(k, text()) for k in range(700)]
    docs += [(1000 + k, docs[3][1]) for k in range(60)]  # ties beyond the tenth place
    docs += [(2000, None), (2001, ""), (2002, "... ---"), (None, docs[9][1]), (None, docs[9][1]), (5, docs[11][1]), (5, docs[11][1])]
    docs += [(3000, " ".join(text() for _ in range(400)))]
    items = [(k, docs[k][1]) for k in range(25)] + [(50, "nothing here occurs"), (51, None), (52, ""), (53, "the THE the"), (None, docs[30][1]),
                                                    (54, docs[31][1]), (54, docs[32][1])]
    return docs, items


def _frames(spark, corpus):
    docs = spark.createDataFrame([(*r, "p", 1, 2, "a") for r in corpus[0]], "doc_id long, text string, place string, n int, kind int, at string")
    return docs.repartition(4), spark.createDataFrame([(*r, 1, 2) for r in corpus[1]], "item_id long, text string, rank int, item int")


def test_search_equals_brute_force(spark, corpus):
    assert got(ball_tree.search(*_frames(spark, corpus))) == brute(*corpus)


def test_small_blocks(spark, corpus, monkeypatch):
    want = brute(*corpus, top=3)
    monkeypatch.setattr(ball_tree, "BLOCK_TERMS", 60)
    assert got(ball_tree.search(*_frames(spark, corpus), top=3)) == want


def test_long_texts_are_counted_alike(monkeypatch):
    raw = "The the É é\x00é 1a_b ".encode() * 50
    want = ball_tree._count(raw)
    monkeypatch.setattr(ball_tree, "LONG_TEXT", 10)
    assert ball_tree._count(raw) == want and want[b"the"] == 100 and want["é".encode()] == 100 and want["É".encode()] == 50


def test_chunks_follow_the_vocabulary():
    assert ball_tree.chunk_docs(100) == ball_tree.CHUNK_DOCS
    assert ball_tree.chunk_docs(10**9) == ball_tree.LEAF


def test_rows_of_the_edge_table(docs, rows, benchmark, none):
    items = [tuple(r) for r in benchmark.collect()]
    assert got(ball_tree.search(docs, benchmark)) == brute([(r[0], r[1]) for r in rows], items)
    assert got(ball_tree.search(none, benchmark)) == [] and got(ball_tree.search(docs, benchmark.limit(0))) == []


def _vectors(rng, n, terms):
    at = [np.sort(rng.choice(terms, rng.integers(1, 20), replace=False)).astype(np.int32) for _ in range(n)]
    impact = [rng.integers(1, 10**6, len(a)).astype(np.int64) for a in at]
    return at, impact


@pytest.mark.parametrize("floored", [False, True])
def test_the_best_rows_are_exact_whatever_the_vectors(floored):
    rng = np.random.default_rng(1)
    terms = 50
    weights = rng.integers(0, 9000, terms).astype(np.int64)
    at, impact = _vectors(rng, 3000, terms)
    groups = [(at[k % 40], impact[k % 40]) for k in range(500)]  # copies
    at, impact = at + [g[0] for g in groups], impact + [g[1] for g in groups]
    queries = [np.sort(rng.choice(terms, 8, replace=False)) for _ in range(20)] + [np.array([3]), np.array([], np.int64)]
    want = []
    for q in queries:
        dense = np.zeros(terms, np.int64)
        dense[q] = weights[q]
        scores = sorted(((int((dense[a] * i).sum()), 1, -k) for k, (a, i) in enumerate(zip(at, impact))), reverse=True)[:10]
        want.append([s for s in scores if s[0] > 0])
    floor = np.array([s[9][0] if len(s) == 10 else 0 for s in want]) if floored else None
    search = ball_tree.Search(queries, weights, 10, floor)
    for lo in range(0, len(at), 1000):
        search.add(list(range(lo, min(lo + 1000, len(at)))), [a.tobytes() for a in at[lo : lo + 1000]], [i.tobytes() for i in impact[lo : lo + 1000]])
    assert [sorted(best, reverse=True) for best in search.best] == want


def test_every_node_bounds_its_rows():
    rng = np.random.default_rng(2)
    terms = 60
    weights = rng.integers(1, 9000, terms).astype(np.int64)
    at, impact = _vectors(rng, 800, terms)
    queries = [np.sort(rng.choice(terms, 9, replace=False)) for _ in range(6)]
    space = ball_tree.Space(queries, weights)
    assert space.own.any() and not space.own.all()
    tree = ball_tree.Tree(ball_tree.Sparse([a.tobytes() for a in at], [i.tobytes() for i in impact], space.scale), space)
    below = {}
    for node in reversed(range(len(tree.members))):
        left, right = tree.children[node]
        below[node] = tree.members[node].tolist() if left < 0 else below[left] + below[right]
    assert sorted(below[0]) == list(range(len(at)))
    assert max(len(m) for m in tree.members) <= ball_tree.LEAF and len(tree.members) <= len(at) // 4
    for item, q in enumerate(queries):
        dense = np.zeros(terms, np.int64)
        dense[q] = weights[q]
        score = [int((dense[a] * i).sum()) for a, i in zip(at, impact)]
        for node, bound in enumerate(tree.bounds(item)):
            assert max(score[k] for k in below[node]) <= bound


def test_subtrees_without_an_items_words_are_pruned():
    rng = np.random.default_rng(4)
    own = [np.arange(10 * k, 10 * k + 10) for k in range(40)]  # every item has words of its own
    weights = np.concatenate([np.full(400, 8000), np.full(5, 500)]).astype(np.int64)  # and all share a few frequent ones
    at, impact = [], []
    for k in range(4000):  # neighbours share an item's words, as documents do when they are dealt
        some = np.sort(np.concatenate([rng.choice(own[k // 100], 4, replace=False), rng.choice(5, 3, replace=False) + 400])).astype(np.int32)
        at.append(some.tobytes())
        impact.append(rng.integers(500_000, 900_000, len(some)).astype(np.int64).tobytes())
    queries = [np.append(o, np.arange(400, 405)) for o in own]
    search = ball_tree.Search(queries, weights, 10)
    search.add(list(range(4000)), at, impact)
    assert search.scored < 0.1 * 40 * 4000
