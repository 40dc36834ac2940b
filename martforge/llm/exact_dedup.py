"""Exact dedup by a 128-bit content hash, in DataFrame expressions only.

1. One pass over the texts writes a narrow row a document: id, position, the
   128-bit hash and the SHA-256 of the normalised text (some 60 bytes).
2. Rows are grouped by the hash, counted map-side, so a hot group is one row a
   task.  The row with the smallest id leads its group.
3. Bytes are compared inside groups: the texts of groups with two rows or more
   (found by a bitmap filter of bounded size) are made distinct by (hash, text),
   again map-side first.  A hash with two different texts is a collision; the
   rows of such hashes are grouped once more, by hash and text.
4. Group figures go back to the rows by a join on the hash.  Groups that hold
   a thousandth of all rows or more are at most a thousand: they are broadcast,
   so no key of the shuffle join is hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martforge.llm.common import SPACE, Scratch, join_counted, read
from martforge.operators import key_filter


def md5_128(text: Column) -> Column:
    """The 128-bit content hash, 16 bytes."""
    return F.unhex(F.md5(text))


def normalised(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text): white space runs as one space, a null text as the empty text."""
    return docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"[{SPACE}]+", " ").alias("text"))


def _first() -> Column:
    """Order of the rows of a group: smallest id, null ids last, repeated ids by position."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos")


def _collisions(rows: DataFrame, groups: DataFrame, digest: Callable[[Column], Column], scratch: Scratch) -> DataFrame | None:
    """The hashes that stand for more than one text; None if there are none."""
    repeated = groups.select(F.xxhash64("h").alias("f"))
    n = repeated.count()
    if not n:
        return None
    bits = key_filter.width(n)
    bitmap = key_filter.build(repeated, "f", bits)
    hashed = rows.select(digest(F.col("text")).alias("h"), "text").withColumn("f", F.xxhash64("h"))
    texts = key_filter.keep_possible(hashed, "f", bitmap, bits).select("h", "text").distinct()
    found = scratch.save(texts.groupBy("h").agg(F.count(F.lit(1)).alias("n_texts")).filter("n_texts > 1").select("h"), "collisions")
    return None if found.isEmpty() else found


def _groups(prints: DataFrame, by: list[str]) -> DataFrame:
    """(by, first, n) of the groups with two rows or more."""
    return prints.groupBy(*by).agg(F.min(_first()).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")


def dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """Per row: (doc_id, keep_id, group_size, kept, text_sha256).

    * a null text is the empty text; empty and blank-only texts differ unless
      equal after white space runs became one space;
    * null ids come last: a group keeps a null id only if it has no other;
    * rows that repeat an id with an equal text are copies too: exactly one row
      of a group is kept, by position among equal ids;
    * extra columns of ``docs`` are not read; an empty table gives an empty result.

    ``digest`` may be any hash: texts that share one without being equal are
    told apart by their bytes."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    rows = normalised(docs, text, key)
    prints = scratch.save(rows.select("doc_id", F.monotonically_increasing_id().alias("pos"), digest(F.col("text")).alias("h"),
                                      F.unhex(F.sha2("text", 256)).alias("sha")), "prints")
    total = prints.count()
    groups = scratch.save(_groups(prints, ["h"]), "groups")
    collided = _collisions(rows, groups, digest, scratch)
    if collided is None:
        out = join_counted(prints, groups, ["h"], "n", total)
    else:
        # the bytes decide: rows of a collided hash carry their text as a second key
        clash = collided.select(F.col("h").alias("c_h"))
        texts = rows.select(F.col("doc_id"), F.monotonically_increasing_id().alias("pos"), digest(F.col("text")).alias("h"),
                            F.unhex(F.sha2("text", 256)).alias("sha"), "text")
        texts = texts.join(clash, F.col("h") == F.col("c_h"), "left")
        texts = texts.select("doc_id", "pos", "h", "sha", F.when(F.col("c_h").isNotNull(), F.col("text")).otherwise("").alias("bytes"))
        prints = scratch.save(texts, "prints-by-bytes")
        groups = scratch.save(_groups(prints, ["h", "bytes"]), "groups-by-bytes")
        out = join_counted(prints, groups, ["h", "bytes"], "n", total)
    alone = F.col("n").isNull()
    return out.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first.pos") == F.col("pos"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
