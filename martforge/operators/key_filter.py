"""A bitmap filter over hashed keys, in DataFrame expressions only.

``build`` sets one bit per key hash; ``may_hold`` / ``keep_possible`` test the
rows of another frame against it.  A clear bit proves that a key is not in the
filter, a set bit only says that it may be: use it to keep rows out of a
shuffle whose exact result does not need them.

The bitmap is a table of chunks (``CHUNK_WORDS`` 64-bit words each), so tasks
build it with ordinary aggregation and the test is a join on the chunk number.
Its size depends on ``bits`` alone, which ``width`` bounds by ``MAX_BITS``:
that join may be a broadcast whatever the data.  With more keys than the bound
allows for, more rows pass, never fewer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BITS = 64
CHUNK_WORDS = 64
CHUNK_BITS = WORD_BITS * CHUNK_WORDS
#: bits of the largest filter: 32 MB of words
MAX_BITS = 1 << 28
#: bits a key, so that about one absent key in sixteen passes
BITS_PER_KEY = 16


def width(keys: int) -> int:
    """Bits for a filter of about ``keys`` keys: a power of two from one chunk to ``MAX_BITS``."""
    bits = CHUNK_BITS
    while bits < min(keys * BITS_PER_KEY, MAX_BITS):
        bits *= 2
    return bits


def build(keys: DataFrame, hash_col: str, bits: int) -> DataFrame:
    """``(chunk long, words array<long>)`` with a set bit for every non-NULL long in ``hash_col``.

    Chunks without a set bit have no row.  Two small shuffles: words, combined
    map-side, then at most ``CHUNK_WORDS`` of them a chunk."""
    at = F.pmod(F.col(hash_col), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(WORD_BITS)).cast("int"))
    words = (keys.filter(F.col(hash_col).isNotNull())
             .groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits")))
    slot = F.pmod("word", F.lit(CHUNK_WORDS)).cast("int")
    chunks = words.groupBy(F.shiftright("word", 6).alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(slot.alias("slot"), "bits"))).alias("by_slot"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(CHUNK_WORDS - 1)),
                        lambda i: F.coalesce(F.try_element_at("by_slot", i), F.lit(0).cast("long")))
    return chunks.select("chunk", dense.alias("words"))


def keep_possible(rows: DataFrame, hash_col: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows whose hash may be in the filter (NULL hashes are not); columns unchanged.

    ``bitmap`` is what ``build`` made with the same ``bits``: at most
    ``bits / 8`` bytes of words, so the broadcast is bounded."""
    at = F.pmod(F.col(hash_col), F.lit(bits))
    probe = rows.withColumn("_chunk", F.shiftright(at, 12)).withColumn("_bit", F.pmod(at, F.lit(CHUNK_BITS)).cast("int"))
    side = bitmap.select(F.col("chunk").alias("_chunk"), F.col("words").alias("_words"))
    hit = F.getbit(F.get("_words", F.shiftright("_bit", 6)), F.pmod("_bit", F.lit(WORD_BITS))) == 1
    return probe.join(F.broadcast(side), "_chunk").filter(hit).select(*rows.columns)
