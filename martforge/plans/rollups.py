"""Roll-ups M9-M11.

Each child table is aggregated to the join key *before* joining (items,
payments and reviews never fan out against each other).  All three child
roll-ups leave their aggregation hash-partitioned on ``order_id``, as does the
orders side once shuffled, so the three left joins of M9 run as one
co-partitioned stage.  Hot keys are absorbed by partial (map-side)
aggregation and the partial window group limit; AQE splits a skewed join
partition at runtime.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions import avg_exact, avg_money, day_diff, round_half_up, safe_ratio_pct, sum_money
from martforge.functions.numeric import EXACT
from martforge.operators.aggregates import arg_max
from martforge.operators.latest import latest_per_key


#: a key is hot if it holds more than 1 / HOT_KEYS of all rows, so there are fewer than HOT_KEYS of them
HOT_KEYS = 1000


def hot_keys(rows: DataFrame, column: str) -> list[str]:
    """The hot values of a text column, fewer than ``HOT_KEYS``.  One pass over that column, without a shuffle of it.

    A frequent-items sketch of ten times as many entries misses no value above
    the bound; a value that is listed without being hot does no harm."""
    top = F.call_function("approx_top_k", F.col(column), F.lit(HOT_KEYS), F.lit(10 * HOT_KEYS))
    found = rows.filter(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return sorted(t["item"] for t in found["top"] or () if t["count"] * HOT_KEYS > found["n"])


def _apart(rows: DataFrame, key: str, hot: Collection[str] | None, roll: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``roll`` over rows that were sent to the task of their ``key``, so that no level of it shuffles again.

    Where hardly any rows combine before a shuffle, partial results are larger
    than the rows.  Rows of the ``hot`` keys (``hot_keys``) are combined first
    instead, and so are all rows if ``hot`` is None (not known).  NULL keys are left out."""
    rows = rows.filter(F.col(key).isNotNull())
    if hot is None:
        return roll(rows)
    is_hot = F.col(key).isin(list(hot))
    out = roll(rows.filter(~is_hot).repartition(key))
    return out.unionByName(roll(rows.filter(is_hot))) if hot else out


def _light(items: DataFrame, *keys: str) -> DataFrame:
    """The key and money columns of items as they are shuffled: the total travels only where it is not price plus freight."""
    price, freight, total = F.col("item_price"), F.col("freight_value"), F.col("total_item_revenue")
    other = F.when(~total.eqNullSafe(price + freight), F.struct(total.alias("is")))
    return items.select(*keys, "item_price", "freight_value", other.alias("other_total"))


def _total() -> Column:
    """``total_item_revenue`` of ``_light`` rows."""
    return F.when(F.col("other_total").isNull(), F.col("item_price") + F.col("freight_value")).otherwise(F.col("other_total").getField("is"))


def items_per_order(items: DataFrame, hot: Collection[str] | None = None) -> DataFrame:
    """AG2/AG4/AG5 per order: count, money sums, distinct sellers.  Items without an order id belong to no order."""
    i = _light(items, "order_id", "seller_id")
    return _apart(i, "order_id", hot, lambda rows: rows.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        sum_money("item_price").alias("items_subtotal"),
        sum_money("freight_value").alias("freight_total"),
        sum_money(_total()).alias("order_gross_revenue"),
        F.countDistinct("seller_id").alias("distinct_sellers"),
    ))


def payments_per_order(payments: DataFrame, numeric_order: bool = False) -> DataFrame:
    """Payment sum, most instalments and the primary type: the type of the
    highest ``payment_sequential`` — compared as text unless ``numeric_order``
    (Q1), ties broken by the type itself (Q2)."""
    return payments.groupBy("order_id").agg(
        sum_money("payment_amount").alias("total_payment_amount"),
        F.max("payment_installments").alias("max_installments"),
        arg_max("payment_type", ["payment_sequential", "payment_type"], numeric_order=numeric_order)
        .alias("primary_payment_type"),
    )


REVIEW_TEXT = ("review_title", "review_message")


def latest_review(reviews: DataFrame, columns: Sequence[str]) -> DataFrame:
    """WN1: the wanted columns of one review per order — latest creation time,
    a NULL time counting as the latest (Q4), then the larger review id.  The
    order ends with the wanted columns, so it is total on what is returned
    (re-submitted reviews can share id and creation second) and a column that
    is not wanted is neither read nor sorted."""
    return latest_per_key(
        reviews.select("order_id", "review_id", "review_created_at", *columns),
        ["order_id"],
        [F.col("review_created_at").desc_nulls_first(), F.col("review_id").desc_nulls_last(),
         *[F.col(c).desc_nulls_last() for c in columns]],
    ).select("order_id", *columns)


def orders_enriched(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame,
                    numeric_payment_order: bool = False, review_text: bool = True,
                    hot: Collection[str] | None = None) -> DataFrame:
    """M9: one row per order with item, payment and review roll-ups and flags.
    Item metrics are zero-filled for orders without items; payment and review
    columns stay NULL (Q5).  Without ``review_text`` the title and message,
    which no other model uses, are left out: free text as a sort key would
    otherwise travel the whole shuffle.  ``hot``: the hot order ids of the items
    (``hot_keys``), if known."""
    oi = items_per_order(items, hot)
    op = payments_per_order(payments, numeric_payment_order)
    text = REVIEW_TEXT if review_text else ()
    r = latest_review(reviews, ["review_score", "response_time_hours", *text]).withColumnRenamed(
        "response_time_hours", "review_response_hours")
    j = orders.join(oi, "order_id", "left").join(op, "order_id", "left").join(r, "order_id", "left")
    return j.select(
        "order_id", "customer_id", "order_status", "purchased_at", "approved_at", "delivered_to_carrier_at",
        "delivered_to_customer_at", "estimated_delivery_at", "actual_delivery_days", "estimated_delivery_days",
        "delivery_delay_days",
        F.coalesce(F.col("delivery_delay_days") > 0, F.lit(False)).alias("is_late_delivery"),
        F.coalesce(F.col("item_count"), F.lit(0).cast("long")).alias("item_count"),
        F.coalesce(F.col("items_subtotal"), F.lit(0.0)).alias("items_subtotal"),
        F.coalesce(F.col("freight_total"), F.lit(0.0)).alias("freight_total"),
        F.coalesce(F.col("order_gross_revenue"), F.lit(0.0)).alias("order_gross_revenue"),
        F.coalesce(F.col("distinct_sellers"), F.lit(0).cast("long")).alias("distinct_sellers"),
        "total_payment_amount", "max_installments", "primary_payment_type",
        "review_score", *text, "review_response_hours",
        F.coalesce(F.col("order_status") == "delivered", F.lit(False)).alias("is_delivered"),
        F.coalesce(F.col("review_score") >= 4, F.lit(False)).alias("is_positive_review"),
    )


def customer_rollup(enriched: DataFrame, customers: DataFrame) -> DataFrame:
    """M10: one row per person (``customer_unique_id``): location of the latest
    order, counts, lifetime value, tenure, satisfaction, segment.  Orders with no
    customer row are dropped by the inner join (Q12)."""
    oc = enriched.select(
        "order_id", "customer_id", "purchased_at", "is_delivered", "order_gross_revenue", "review_score",
        "delivery_delay_days",
    ).join(
        customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state", "zip_code_prefix"),
        "customer_id", "inner",
    )
    # One arg-max carries all three location fields: they come from the same
    # (latest) order, so a single aggregation buffer serves them.
    location = F.struct("customer_city", "customer_state", "zip_code_prefix")
    m = oc.groupBy("customer_unique_id").agg(
        arg_max(location, ["purchased_at", "order_id"]).alias("__loc"),
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("is_delivered")).alias("delivered_orders"),
        sum_money("order_gross_revenue").alias("lifetime_revenue"),
        avg_money("order_gross_revenue").alias("avg_order_value"),
        F.min("order_gross_revenue").alias("min_order_value"),
        F.max("order_gross_revenue").alias("max_order_value"),
        F.min("purchased_at").alias("first_order_at"),
        F.max("purchased_at").alias("most_recent_order_at"),
        avg_exact("review_score").alias("avg_review_score"),
        avg_exact("delivery_delay_days").alias("avg_delivery_delay_days"),
    )
    n = F.col("total_orders")
    return m.select(
        "customer_unique_id", "__loc.customer_city", "__loc.customer_state", "__loc.zip_code_prefix", "total_orders",
        "delivered_orders", "lifetime_revenue", "avg_order_value", "min_order_value", "max_order_value",
        "first_order_at", "most_recent_order_at",
        day_diff("first_order_at", "most_recent_order_at").alias("customer_tenure_days"),
        "avg_review_score", "avg_delivery_delay_days",
        F.when(n == 1, "one_time").when(n.between(2, 3), "occasional").otherwise("repeat").alias("customer_segment"),
    )


SELLER_METRIC_COLUMNS = [
    "total_orders", "total_items_sold", "distinct_products", "total_revenue", "avg_item_price",
    "total_freight_revenue", "delivered_orders", "on_time_deliveries", "avg_delay_days", "on_time_rate_pct",
    "avg_review_score", "review_count", "seller_score", "first_sale_at", "most_recent_sale_at",
]


def seller_score(avg_review, on_time_rate_pct, distinct_orders):
    """AG15: 40% rating (NULL rating counts as 3 of 5), 40% on-time rate,
    20% volume ``min(ln(n+1)/ln(1000)*100, 100)``; rounded to 2."""
    rating = F.coalesce(avg_review, F.lit(3.0)) / 5.0 * 100 * 0.40
    volume = F.least(F.log(distinct_orders.cast("double") + 1) / F.log(F.lit(1000.0)) * 100, F.lit(100.0)) * 0.20
    return round_half_up(rating + on_time_rate_pct * 0.40 + volume, 2)


#: an order is hot if it holds more than 1 / HOT_ORDERS of all items, so there are fewer than HOT_ORDERS of them
HOT_ORDERS = 1000


def hot_orders(enriched: DataFrame) -> DataFrame | None:
    """``order_id`` of the hot orders, fewer than ``HOT_ORDERS``; None if there is none.  Counts the stored order table."""
    total = enriched.agg(F.sum("item_count")).first()[0] or 0
    hot = enriched.filter(F.col("item_count") * HOT_ORDERS > total).select("order_id")
    return None if hot.isEmpty() else hot


#: M11's measures: name -> (over item rows, over the partial results)
def _seller_measures() -> dict[str, tuple[Column, Callable[[str], Column]]]:
    on_time = F.when(F.col("delivery_delay_days") <= 0, 1).otherwise(0)
    exact = lambda c: F.sum(c.cast(EXACT))
    total, least, most = F.sum, F.min, F.max
    return {
        "orders": (F.sum("new_order"), total),
        "items": (F.sum("is_item"), total),
        "revenue": (exact(_total()), total),
        "price": (exact(F.col("item_price")), total), "n_price": (F.count("item_price"), total),
        "freight": (exact(F.col("freight_value")), total),
        "delivered": (F.count_if(F.col("is_delivered")), total),
        "on_time": (F.sum(on_time * F.col("is_item")), total),
        "delay": (F.sum(F.col("delivery_delay_days").cast("long")), total), "n_delay": (F.count("delivery_delay_days"), total),
        "score": (F.sum(F.col("review_score").cast("long")), total), "n_score": (F.count("review_score"), total),
        "first_at": (F.min("purchased_at"), least), "last_at": (F.max("purchased_at"), most),
    }


def seller_rollup(items: DataFrame, enriched: DataFrame, sellers: DataFrame, hot: DataFrame | None = None,
                  busy: Collection[str] | None = None) -> DataFrame:
    """M11: per seller, over item rows joined to their order.  Delivery and review
    figures are item-weighted while the rate divides by distinct orders (Q3),
    so the rate can pass 100.  Sellers without sales stay, with NULL metrics.

    The two distinct counts need no copies of the item rows.  The join leaves
    an order's rows together, so the first row of each (order, seller) is marked
    there and distinct orders become a sum.  Everything is then added up by
    (seller, product) and once more by seller, where distinct products are the
    rows counted: in the seller's task, but for the ``busy`` sellers (``hot_keys``
    of the items; None: not known, so for all), whom the first level spreads.
    The items of ``hot`` orders (``hot_orders``, a bounded list) are not gathered
    by order: they meet their order in a broadcast, and their (order, seller)
    pairs are made distinct."""
    i = _light(items, "seller_id", "order_id", "product_id")
    e = enriched.select("order_id", "purchased_at", "is_delivered", "delivery_delay_days", "review_score")
    cold_items = i if hot is None else i.join(F.broadcast(hot), "order_id", "left_anti")
    pair = Window.partitionBy("order_id", "seller_id").orderBy(F.lit(0))
    so = cold_items.join(e, "order_id", "inner").withColumns({
        "new_order": (F.row_number().over(pair) == 1).cast("int"), "is_item": F.lit(1)})
    if hot is not None:
        hot_rows = i.join(F.broadcast(e.join(F.broadcast(hot), "order_id", "left_semi")), "order_id", "inner")
        pairs = hot_rows.select("seller_id", "order_id").distinct().withColumns({"new_order": F.lit(1), "is_item": F.lit(0)})
        so = so.unionByName(hot_rows.withColumns({"new_order": F.lit(0), "is_item": F.lit(1)}))
        so = so.unionByName(pairs, allowMissingColumns=True)
    measures = _seller_measures()

    def by_seller(rows: DataFrame) -> DataFrame:
        by_product = rows.groupBy("seller_id", "product_id").agg(*[first.alias(name) for name, (first, _) in measures.items()])
        return by_product.groupBy("seller_id").agg(F.count("product_id").alias("products"), *[again(name).alias(name) for name, (_, again) in measures.items()])

    m = _apart(so.drop("order_id"), "seller_id", busy, by_seller)
    share = lambda a, n: F.col(a).cast("double") / F.nullif(F.col(n), F.lit(0))
    whole = lambda c: F.col(c).cast("long")
    m = m.select(
        "seller_id", whole("orders").alias("total_orders"), whole("items").alias("total_items_sold"), F.col("products").alias("distinct_products"),
        F.col("revenue").cast("double").alias("total_revenue"), share("price", "n_price").alias("avg_item_price"),
        F.col("freight").cast("double").alias("total_freight_revenue"), whole("delivered").alias("delivered_orders"),
        whole("on_time").alias("on_time_deliveries"), share("delay", "n_delay").alias("avg_delay_days"),
        share("score", "n_score").alias("avg_review_score"), whole("n_score").alias("review_count"),
        F.col("first_at").alias("first_sale_at"), F.col("last_at").alias("most_recent_sale_at"))
    rate = safe_ratio_pct(F.col("on_time_deliveries"), F.col("total_orders"))
    m = m.withColumn("on_time_rate_pct", rate).withColumn(
        "seller_score", seller_score(F.col("avg_review_score"), F.col("on_time_rate_pct"), F.col("total_orders"))
    )
    s = sellers.select("seller_id", "seller_city", "seller_state", "zip_code_prefix")
    return s.join(m, "seller_id", "left").select(
        "seller_id", "seller_city", "seller_state", "zip_code_prefix", *SELLER_METRIC_COLUMNS
    )
