"""Adapter: the nine raw text tables derived from the star-schema test data.

The test data has no retail-order tables, so each raw table is computed from
one given table with integer arithmetic and text only (FIXTURES.md §3).  The
same rules are written in DuckDB SQL for the oracle (``duck_oracle/``), so both
engines see identical raw text.  Every source row is kept: keys without a
partner are made by writing a key that matches nothing (letters V to Z), and
sellers without sales by one more seller per supplier.  Everything is lazy,
per row and without a shuffle (but for the distinct category names).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss"
# Fixed values used by the adapter rules.
STATE_LETTERS = "acalapambaceesdfgomamg"
ZIP_MODULUS = 211
SELLERS_PER_SUPPLIER = 21  # the last of them sells nothing


def _s(c: Column) -> Column:
    return c.cast("string")


def pad(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_s(n), 8, "0"))


def money_text(cents: Column) -> Column:
    return F.concat(_s(F.floor(cents / 100).cast("long")), F.lit("."), F.lpad(_s(cents % 100), 2, "0"))


def zip_text(n: Column) -> Column:
    return F.lpad(_s(n % ZIP_MODULUS), 5, "0")


def state_text(n: Column) -> Column:
    return F.substr(F.lit(STATE_LETTERS), (n % 11) * 2 + 1, F.lit(2))


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, TS_TEXT)


def plus_seconds(ts: Column, secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ts)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    m = k % 40
    status = (
        F.when(m == 1, " Shipped ").when(m == 2, "CANCELED").when(m == 3, "invoiced")
        .when(m == 4, "processing").when(m == 5, "approved").when(m == 6, "unavailable")
        .when(m == 7, "created").otherwise(" Delivered")
    )
    delivered = ~m.between(1, 7)
    p = plus_seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    return o.select(
        pad("O", k).alias("order_id"),
        pad("C", k).alias("customer_id"),
        status.alias("order_status"),
        F.when(k % 97 == 0, F.lit("not a date")).otherwise(ts_text(p)).alias("order_purchase_timestamp"),
        F.when(k % 50 != 0, ts_text(F.timestamp_add("HOUR", k % 30, p))).alias("order_approved_at"),
        F.when(delivered, ts_text(F.timestamp_add("DAY", F.lit(2), p))).alias("order_delivered_carrier_date"),
        F.when(delivered, ts_text(plus_seconds(F.timestamp_add("DAY", 5 + k % 20 + k % 11, p), k % 86400)))
        .alias("order_delivered_customer_date"),
        ts_text(F.timestamp_add("DAY", F.lit(20), F.date_trunc("DAY", p).cast("timestamp_ntz")))
        .alias("order_estimated_delivery_date"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    q = F.col("o_custkey") * 10 + k % 6
    v = q + (k / 6).cast("long") % 2
    return o.select(
        F.when(k % 301 == 0, pad("Z", k)).otherwise(pad("C", k)).alias("customer_id"),
        pad("U", q).alias("customer_unique_id"),
        F.when(q % 53 != 0, zip_text(v)).alias("customer_zip_code_prefix"),
        F.concat(F.lit("  City "), _s(v % ZIP_MODULUS)).alias("customer_city"),
        state_text(v).alias("customer_state"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity").cast("long")
    return li.select(
        pad("O", F.col("l_orderkey")).alias("order_id"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", qty).alias("order_item_id"),
        pad("P", F.col("l_partkey")).alias("product_id"),
        pad("S", F.col("l_suppkey") * SELLERS_PER_SUPPLIER + F.col("l_orderkey") % (SELLERS_PER_SUPPLIER - 1)).alias("seller_id"),
        ts_text(F.col("l_shipdate")).alias("shipping_limit_date"),
        money_text((F.col("l_partkey") * 37 + F.col("l_suppkey") * 11 + qty * 101) % 30000 + 100).alias("price"),
        money_text((F.col("l_partkey") + qty * 7) % 4000).alias("freight_value"),
    )


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    n = F.when(k % 5 == 0, k % 12 + 1).otherwise(F.lit(1))
    o = o.select(k, F.explode(F.sequence(F.lit(1).cast("long"), n.cast("long"))).alias("i"))
    i = F.col("i")
    t = (k + i) % 5
    ptype = (
        F.when(t == 0, "Credit_Card ").when(t == 1, " boleto").when(t == 2, "VOUCHER")
        .when(t == 3, "debit_card").otherwise("not_defined")
    )
    return o.select(
        F.when(k % 83 == 0, pad("Y", k)).otherwise(pad("O", k)).alias("order_id"),
        _s(i).alias("payment_sequential"),
        ptype.alias("payment_type"),
        _s((k + i) % 10 + 1).alias("payment_installments"),
        money_text((k * 31 + i * 97) % 50000 + 1).alias("payment_value"),
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    eid = F.col("event_id")
    n = eid - F.when((eid % 3 == 0) & (eid > 0), 1).otherwise(0)
    score = F.when(eid % 7 == 0, F.col("user_id") % 5 + 1).otherwise(5 - (n % 20 / 4).cast("long"))
    title = F.when(eid % 3 == 1, F.lit("   ")).when(eid % 3 == 2, F.lit(" ok "))
    return e.select(
        pad("R", (eid / 2).cast("long")).alias("review_id"),
        pad("O", n).alias("order_id"),
        _s(score).alias("review_score"),
        title.alias("review_comment_title"),
        F.concat(F.lit(" "), F.col("event_type")).alias("review_comment_message"),
        F.when(eid % 41 == 0, F.lit("")).otherwise(ts_text(F.col("ts"))).alias("review_creation_date"),
        ts_text(F.timestamp_add("MINUTE", F.col("user_id") * 17, F.col("ts"))).alias("review_answer_timestamp"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        pad("P", key).alias("product_id"),
        F.when(key % 61 != 0, F.lower(F.col("p_type"))).alias("product_category_name"),
        _s(F.length("p_name")).alias("product_name_lenght"),
        _s(size * 10).alias("product_description_lenght"),
        _s(size % 6).alias("product_photos_qty"),
        _s(size * 50).alias("product_weight_g"),
        F.when(key % 71 != 0, _s(size)).alias("product_length_cm"),
        _s(size % 17 + 1).alias("product_height_cm"),
        _s(size % 23 + 1).alias("product_width_cm"),
    )


def raw_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read(spark, sf_dir, "part").select(F.lower(F.col("p_type")).alias("product_category_name")).distinct()
    smallest = names.agg(F.min("product_category_name").alias("__min"))
    # A global aggregate is one row, so broadcasting it is bounded.
    name = F.col("product_category_name")
    return (
        names.join(F.broadcast(smallest), name == F.col("__min"), "left")
        .select(F.when(F.col("__min").isNull(), name).otherwise(F.concat(F.lit("x_"), name)).alias("product_category_name"),
                F.concat(F.lit("en_"), name).alias("product_category_name_english"))
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    s = s.select("s_suppkey", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SELLERS_PER_SUPPLIER - 1).cast("long"))).alias("j"))
    s = s.select((F.col("s_suppkey") * SELLERS_PER_SUPPLIER + F.col("j")).alias("s"))
    v = F.col("s")
    return s.select(
        pad("S", v).alias("seller_id"),
        zip_text(v).alias("seller_zip_code_prefix"),
        F.concat(F.lit(" City "), _s(v % ZIP_MODULUS)).alias("seller_city"),
        state_text(v).alias("seller_state"),
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")

    def coord(base: int, mult: int) -> Column:
        return F.concat(F.lit("-"), _s(base + key % 20), F.lit("."), F.lpad(_s((key * mult) % 1000), 3, "0"))

    return c.select(
        F.when(key % ZIP_MODULUS == 7, F.concat(F.lit("V"), zip_text(key))).otherwise(zip_text(key)).alias("geolocation_zip_code_prefix"),
        coord(10, 13).alias("geolocation_lat"),
        coord(40, 29).alias("geolocation_lng"),
        F.concat(F.lit("City"), _s(F.col("c_nationkey") % 3)).alias("geolocation_city"),
        state_text(F.col("c_nationkey")).alias("geolocation_state"),
    )


BUILDERS = {
    "customers": raw_customers,
    "geolocation": raw_geolocation,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
    "orders": raw_orders,
    "products": raw_products,
    "sellers": raw_sellers,
    "product_category_name_translation": raw_translation,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All nine raw text tables (lazy)."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}
