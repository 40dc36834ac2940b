"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Both sides keep the minimum ``k``-gram hash of every run of ``window - k + 1``
consecutive k-grams.  A span of ``window`` words that both sides share has the
same hashes on both sides, so the same minimum is kept at the same place: no
shared window is missed.  Kept fingerprints are joined, and each hit is
extended along its diagonal with the neighbouring k-gram hashes it carries: a
window holds when its first and last k-gram (2 x k = ``window`` words) agree.

The test side (benchmark fingerprints) is broadcast only while its counted
rows stay under ``BROADCAST_ROWS``; beyond it the join is a shuffle join, with
AQE splitting the skewed fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martforge.llm import words as W
from martforge.llm.common import Scratch, read, small, texts

K = 5
WINDOW = 2 * K
RUN = WINDOW - K + 1  # k-grams in a window
BROADCAST_ROWS = 500_000  # ~150 bytes a row: below 80 MB


def _fingerprints(h: Column) -> Column:
    """(pos, hash, ctx) of the kept k-grams; ctx: k-gram hashes from pos - K to pos + K, null outside."""
    def keep(mins: Column) -> Column:
        """A k-gram is kept if it is the minimum of some run that holds it (ties: all of them)."""
        return F.filter(W.upto(F.size(h)), lambda i: F.get(h, i) == F.greatest(*[F.get(mins, i - j) for j in range(RUN)]))

    runs = F.transform(W.upto(F.size(h) - F.lit(RUN - 1)), lambda s: F.least(*[F.get(h, s + j) for j in range(RUN)]))
    kept = W.let(runs, keep)
    return F.transform(kept, lambda i: F.struct(
        i.alias("pos"), F.get(h, i).alias("hash"), F.array(*[F.get(h, i + j) for j in range(-K, K + 1)]).alias("ctx")))


def _exploded(rows: DataFrame, key: list[str]) -> DataFrame:
    f = F.explode(W.let(W.gram_hashes(W.alnum_words(F.col("text")), K), _fingerprints)).alias("f")
    return rows.select(*key, f).select(*key, F.col("f.pos").alias("pos"), F.col("f.hash").alias("hash"), F.col("f.ctx").alias("ctx"))


def _short(rows: DataFrame, key: list[str], length: int) -> DataFrame:
    """(key, pos, hash) of all runs of ``length`` words, for items shorter than a window."""
    return rows.select(*key, F.posexplode(W.gram_hashes(W.alnum_words(F.col("text")), length)).alias("pos", "hash"))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, th, start, end, item_id): every occurrence of an item window in a document.

    th is a hash of the text and tells rows with a repeated doc_id apart."""
    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    items = (texts(benchmark, key="item_id").withColumnRenamed("doc_id", "item_id").distinct()
             .withColumn("n", F.size(W.alnum_words(F.col("text")))).filter("n > 0"))
    long_items = _exploded(items.filter(f"n >= {WINDOW}"), ["item_id"]).withColumnRenamed("ctx", "item_ctx").drop("pos")
    long_items = long_items.distinct()
    if long_items.count() <= BROADCAST_ROWS:
        long_items = F.broadcast(long_items)
    seeds = _exploded(rows, ["doc_id", "th"]).join(long_items, "hash")
    starts = F.filter(F.array(*[
        F.when((F.get("ctx", F.lit(j)) == F.get("item_ctx", F.lit(j))) & (F.get("ctx", F.lit(j + K)) == F.get("item_ctx", F.lit(j + K))),
               F.col("pos") - K + j) for j in range(RUN)]), lambda s: s.isNotNull())
    found = seeds.select("doc_id", "th", F.explode(starts).alias("start"), "item_id").withColumn("end", F.col("start") + WINDOW)
    lengths = [r[0] for r in items.filter(f"n < {WINDOW}").select("n").distinct().collect()]  # at most WINDOW - 1 values
    for length in sorted(lengths):
        some = items.filter(F.col("n") == length)
        short = _short(some, ["item_id"], length).drop("pos")
        if short.count() <= BROADCAST_ROWS:
            short = F.broadcast(short)
        found = found.unionByName(_short(rows, ["doc_id", "th"], length).join(short, "hash").select(
            "doc_id", "th", F.col("pos").alias("start"), "item_id", (F.col("pos") + length).alias("end")))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated).

    Null and empty texts have no words and no hits; an item without words has
    no window; repeated items count once; rows that repeat a doc_id are judged
    each by its own text; null item_ids match but are in no item list.  Empty
    tables give an empty result, or no hits."""
    found = hits(docs, benchmark)
    per_span = found.groupBy("doc_id", "th", "start", "end").agg(F.collect_set("item_id").alias("items"))
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "end"))),
        F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(F.greatest(a["upto"], s["end"]).alias("upto"),
                              (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["upto"], s["start"]))).alias("n")),
        lambda a: a["n"])
    per_doc = per_span.groupBy("doc_id", "th").agg(
        covered.alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))).cast("array<string>")).alias("items"))
    base = texts(docs).select("doc_id", F.xxhash64("text").alias("th"), F.size(W.alnum_words(F.col("text"))).cast("long").alias("n_words"))
    hit = per_doc.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("th", "hit_th")
    joined = base.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that hold a benchmark window; every column stays, null ids and texts too."""
    found = hits(docs, benchmark).select(F.col("doc_id").alias("__hit_id"), F.col("th").alias("__hit_th")).distinct()
    found = small(Scratch(docs.sparkSession, "hits").save(found, "hits"))
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__hit_id")) & (th == F.col("__hit_th"))
    return docs.join(found, same, "left_anti")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS g
       FROM b, LATERAL (SELECT unnest(range(1, greatest(1, len(w) - 8) + 1)) AS s) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, s, array_to_string(list_slice(w, s, s + k - 1), ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks)),
h AS (SELECT doc_id, s, dw.k, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.k = bw.k),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
"""
