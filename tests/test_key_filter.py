"""The bitmap filter: no member is ever lost, the size is bounded, absent keys mostly go."""

from pyspark.sql import functions as F

from martforge.operators import key_filter


def test_width_is_bounded():
    assert key_filter.width(0) == key_filter.CHUNK_BITS
    assert key_filter.width(1000) == 16384
    assert key_filter.width(10**15) == key_filter.MAX_BITS


def test_members_pass_and_most_others_go(spark):
    keys = spark.range(0, 3000).select(F.xxhash64("id").alias("h"), F.col("id").alias("_x"))
    bits = key_filter.width(3000)
    bitmap = key_filter.build(keys.union(spark.createDataFrame([(None, None)], "h long, _x long")), "h", bits)
    rows = spark.range(0, 60_000).select("id", F.xxhash64("id").alias("h")).union(spark.createDataFrame([(-1, None)], "id long, h long"))
    passed = key_filter.keep_possible(rows, "h", bitmap, bits)
    assert passed.columns == ["id", "h"]
    ids = {r["id"] for r in passed.select("id").collect()}
    assert set(range(3000)) <= ids and -1 not in ids
    assert len(ids) < 3000 + 57_000 * 0.1


def test_an_empty_filter_lets_nothing_pass(spark):
    keys = spark.createDataFrame([], "h long")
    bitmap = key_filter.build(keys, "h", key_filter.CHUNK_BITS)
    assert key_filter.keep_possible(spark.range(5).select(F.xxhash64("id").alias("h")), "h", bitmap, key_filter.CHUNK_BITS).count() == 0


def test_a_bitmap_too_small_for_its_keys_loses_none(spark):
    keys = spark.range(0, 20_000).select(F.xxhash64("id").alias("h"))
    bitmap = key_filter.build(keys, "h", key_filter.CHUNK_BITS)
    assert key_filter.keep_possible(keys, "h", bitmap, key_filter.CHUNK_BITS).count() == 20_000
