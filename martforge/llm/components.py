"""Connected components of an undirected edge list, by alternating stars.

Every round hangs each node's larger neighbours (large star), then its smaller
ones (small star), on the smallest node it sees, until nothing changes; the
number of rounds grows with the logarithm of the longest path.  Each step is a
minimum per node and a join, so a node with very many neighbours is never
collected (its minimum is taken map-side, and AQE splits its join)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martforge.llm.common import Scratch

EDGES_PER_TASK = 200_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v): one star step."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter("v <= u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = near.filter("v > u") if large else near
    out = moved.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _sum(edges: DataFrame) -> tuple:
    """Tells edge sets apart: their size and the sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): every node of an edge (u, v), with the smallest node of its component."""
    now = scratch.save(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    mark = _sum(now)
    while mark[0]:
        tasks = 1 + mark[0] // EDGES_PER_TASK  # few edges in very many tasks and files cost more than the work on them
        step = scratch.save(_star(now, True).coalesce(tasks), "large")
        new = scratch.save(_star(step, False).coalesce(tasks), "small")
        scratch.drop(step, now)
        now, before, mark = new, mark, _sum(new)
        if mark == before:
            break
    node = lambda c: now.select(F.col(c).alias("node"), F.col("v").alias("component"))
    return node("u").union(node("v")).distinct()
