"""What a run leaves on disk: scratch copies and the shuffle files of finished steps."""

import os
import time

import pytest
from pyspark.sql import functions as F

from martforge.plans import rollups
from martforge.session import RELEASE_SHUFFLES, checkpoint_dir, shuffles_released
from tests.conftest import SF_SMALL
from tools.plan_text import plan_text

ITEMS = ("order_id string, seller_id string, product_id string, item_price double, freight_value double, "
         "total_item_revenue double")


@pytest.fixture(scope="module")
def items(spark):
    """Order o0 and seller s0 hold a third of the rows each; NULL ids; repeated (order, seller) and (seller, product) pairs."""
    rows = []
    for k in range(3000):
        order = "o0" if k % 3 == 0 else None if k % 50 == 1 else f"o{k // 7}"
        seller = "s0" if k % 3 == 1 else None if k % 41 == 0 else f"s{k % 200}"
        price = None if k % 17 == 0 else k / 100
        total = None if price is None else price + 0.1
        rows.append((order, seller, f"p{k % 13}", price, 0.1, (None, 7.25)[k % 2] if k % 19 == 0 else total))  # not always the sum
    return spark.createDataFrame(rows, ITEMS)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def hash_exchanges(df):
    return plan_text(df).count("hashpartitioning")


def test_items_of_an_order_are_shuffled_once(spark, items):
    plain = rollups.items_per_order(items)
    assert same(plain, rollups.items_per_order(items, []))
    assert same(plain, rollups.items_per_order(items, ["o0", "o3", "none"]))
    expected = {r.order_id: (r.n, r.s, r.t) for r in items.filter("order_id IS NOT NULL").groupBy("order_id").agg(
        F.count("*").alias("n"), F.countDistinct("seller_id").alias("s"), F.sum(F.col("total_item_revenue").cast("decimal(28,10)")).cast("double").alias("t")).collect()}
    assert {r.order_id: (r.item_count, r.distinct_sellers, r.order_gross_revenue) for r in rollups.items_per_order(items, ["o0"]).collect()} == expected
    assert hash_exchanges(plain) == 2 and hash_exchanges(rollups.items_per_order(items, [])) == 1


def test_items_of_a_seller_are_shuffled_once_after_their_order(spark, items):
    orders = spark.range(500).select(
        F.concat(F.lit("o"), "id").alias("order_id"), F.expr("timestamp_ntz'2018-01-01 00:00:00' + make_dt_interval(int(id))").alias("purchased_at"),
        (F.col("id") % 2 == 0).alias("is_delivered"), F.when(F.col("id") % 5 != 0, F.col("id") % 9 - 4).cast("int").alias("delivery_delay_days"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 5 + 1).cast("int").alias("review_score"))
    sellers = spark.createDataFrame([(f"s{k}", "c", "SP", "0") for k in range(210)] + [(None, "c", "SP", "0")],
                                    "seller_id string, seller_city string, seller_state string, zip_code_prefix string")
    plain = rollups.seller_rollup(items, orders, sellers)
    assert (hash_exchanges(plain), hash_exchanges(rollups.seller_rollup(items, orders, sellers, None, []))) == (4, 3)
    hot = spark.createDataFrame([("o0",)], "order_id string")
    for hot_order, busy in ((None, []), (None, ["s0", "s7", "none"]), (hot, ["s0"]), (hot, [])):
        assert same(plain, rollups.seller_rollup(items, orders, sellers, hot_order, busy)), (hot_order, busy)
    assert plain.filter("seller_id = 's0'").first().total_items_sold == items.filter(
        "seller_id = 's0' AND order_id IS NOT NULL").count()
    total = items.filter("order_id IS NOT NULL AND seller_id IS NOT NULL").selectExpr("cast(sum(cast(total_item_revenue AS decimal(28,10))) AS double)").first()[0]
    assert plain.selectExpr("cast(sum(cast(total_revenue AS decimal(28,10))) AS double)").first()[0] == total


def test_hot_keys(spark, items):
    some = items.filter("seller_id IN ('s0', 's1')")
    assert set(rollups.hot_keys(some, "seller_id")) == {"s0", "s1"}
    assert rollups.hot_keys(items.limit(0), "seller_id") == [] == rollups.hot_keys(items.filter("order_id IS NULL"), "order_id")
    many = spark.range(200_000).select(F.when(F.col("id") % 10 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"))
    assert rollups.hot_keys(many, "k") == ["hot"]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    out = set()
    while found.hasNext():
        f = found.next()
        if f.getName().startswith("shuffle_"):
            out.add(f.getPath())
    return out


def left_after(spark, before):
    """New shuffle files, once executors had time to delete them in the background."""
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_shuffle_files_of_a_finished_step_are_deleted(spark, tmp_dir):
    step = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    before = shuffle_files(spark)
    with shuffles_released(spark):
        step.write.parquet(f"{tmp_dir}/a")
        assert not left_after(spark, before)
    assert spark.conf.get(RELEASE_SHUFFLES, None) is None
    spark.conf.set(RELEASE_SHUFFLES, "false")
    with shuffles_released(spark):
        assert spark.conf.get(RELEASE_SHUFFLES) == "false"  # a launcher's choice
    assert spark.conf.get(RELEASE_SHUFFLES) == "false"
    spark.conf.unset(RELEASE_SHUFFLES)
    assert spark.read.parquet(f"{tmp_dir}/a").count() == step.count() == 100


def test_the_check_suite_leaves_no_shuffle_files(spark):
    from martforge.check_queries import check_suite

    before = shuffle_files(spark)
    summary = check_suite(spark, SF_SMALL)
    assert not left_after(spark, before)
    assert summary.count() == 81


def _load_folders(spark):
    base = checkpoint_dir(spark).removeprefix("file:")
    return {f"{base}/{n}" for n in os.listdir(base) if n.startswith("martforge-load-")} if os.path.isdir(base) else set()


def test_a_build_from_csv_keeps_only_its_marts(spark):
    from martforge.io_queries import build_revenue_daily, load_report
    from martforge.plans.graph import models
    from martforge.sources.testdata import raw_tables

    before = _load_folders(spark)
    daily = build_revenue_daily(spark, SF_SMALL)
    (new,) = _load_folders(spark) - before
    assert os.listdir(new) == ["out"]  # the CSV files and the raw tables are gone, and the mart can still be read
    assert same(daily, models(raw_tables(spark, SF_SMALL), as_of="2001-08-01")["fct_revenue_daily"].select(*daily.columns))
    before = _load_folders(spark)
    assert load_report(spark, SF_SMALL).count() == 9
    assert _load_folders(spark) == before


def test_compressed_csv_loads_to_the_same_rows(spark, tmp_dir):
    from martforge.io_queries import write_csv
    from martforge.sources import csv_ingest as ci
    from martforge.sources.contracts import RAW_COLUMNS, raw_schema

    rows = [tuple(None if k % 5 == 0 else f' v,"{k}" ' for _ in RAW_COLUMNS["sellers"]) for k in range(1, 100)]
    df = spark.createDataFrame(rows, raw_schema("sellers"))
    for how in ("none", "lz4"):
        write_csv(df, f"{tmp_dir}/{how}/sellers.csv", how)
        assert same(df, ci.good_rows(ci.read_raw_csv(spark, "sellers", f"{tmp_dir}/{how}/sellers.csv")))
    assert any(n.endswith(".csv.lz4") for n in os.listdir(f"{tmp_dir}/lz4/sellers.csv"))
