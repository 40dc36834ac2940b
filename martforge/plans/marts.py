"""Marts M12-M15: the four stored tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import avg_exact, day_diff, months_back, surrogate_key, sum_money, trunc_ts
from martforge.functions.numeric import avg_money
from martforge.operators.aggregates import conditional_counts
from martforge.operators.windows import period_to_date_sum, rolling_rows_avg, running_total

FCT_ORDERS_COLUMNS = [
    "order_key", "order_id", "customer_id", "customer_unique_id", "order_status", "is_delivered",
    "is_late_delivery", "purchased_at", "purchase_date", "purchase_month", "purchase_year",
    "delivered_to_customer_at", "customer_city", "customer_state", "item_count", "distinct_sellers",
    "items_subtotal", "freight_total", "order_gross_revenue", "total_payment_amount", "primary_payment_type",
    "max_installments", "actual_delivery_days", "estimated_delivery_days", "delivery_delay_days",
    "review_score", "is_positive_review", "review_response_hours",
]


def fct_orders(enriched: DataFrame, customers: DataFrame) -> DataFrame:
    """M12: order fact — key, person id, date parts, every order metric.  Orders
    without a customer row are kept (left join, Q12)."""
    c = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    j = enriched.join(c, "customer_id", "left")
    return j.select(
        surrogate_key("order_id").alias("order_key"),
        "order_id", "customer_id", "customer_unique_id", "order_status", "is_delivered", "is_late_delivery",
        "purchased_at",
        trunc_ts("DAY", "purchased_at").alias("purchase_date"),
        trunc_ts("MONTH", "purchased_at").alias("purchase_month"),
        trunc_ts("YEAR", "purchased_at").alias("purchase_year"),
        "delivered_to_customer_at", "customer_city", "customer_state", "item_count", "distinct_sellers",
        "items_subtotal", "freight_total", "order_gross_revenue", "total_payment_amount", "primary_payment_type",
        "max_installments", "actual_delivery_days", "estimated_delivery_days", "delivery_delay_days",
        "review_score", "is_positive_review", "review_response_hours",
    )


def daily_metrics(enriched: DataFrame) -> DataFrame:
    """Delivered orders (FL1) rolled up to one row per purchase day."""
    d = enriched.filter(F.col("is_delivered"))
    return d.groupBy(F.to_date("purchased_at").alias("revenue_date")).agg(
        F.count("order_id").alias("orders_count"),
        F.sum("item_count").cast("long").alias("items_sold"),
        sum_money("order_gross_revenue").alias("gross_revenue"),
        sum_money("items_subtotal").alias("product_revenue"),
        sum_money("freight_total").alias("freight_revenue"),
        avg_money("order_gross_revenue").alias("avg_order_value"),
        *conditional_counts({
            "credit_card_orders": F.col("primary_payment_type") == "credit_card",
            "boleto_orders": F.col("primary_payment_type") == "boleto",
            "voucher_orders": F.col("primary_payment_type") == "voucher",
        }),
        avg_exact("review_score").alias("avg_review_score"),
        *conditional_counts({
            "positive_reviews": F.col("is_positive_review"),
            "late_deliveries": F.col("is_late_delivery"),
        }),
        avg_exact("delivery_delay_days").alias("avg_delay_days"),
    )


def fct_revenue_daily(enriched: DataFrame) -> DataFrame:
    """M13: daily revenue with a 7-row rolling average (rows, not days — Q6),
    month-to-date and running total; a NULL day (unparsable purchase time)
    is its own row, sorted last (Q9).

    The two whole-series windows run in one task, which is why they are applied
    only after the roll-up to day grain (a few thousand rows at most)."""
    m = daily_metrics(enriched)
    return m.select(
        "*",
        rolling_rows_avg("gross_revenue", "revenue_date", 7).alias("revenue_7d_avg"),
        period_to_date_sum("gross_revenue", "revenue_date", "month").alias("revenue_mtd"),
        running_total("gross_revenue", "revenue_date").alias("revenue_cumulative"),
    ).orderBy(F.col("revenue_date").asc_nulls_last())


def dim_customers(rollup: DataFrame, geolocation: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """M14: person dimension with centroid, CLV tier and activity flag.
    ``is_active``: latest order within six months before ``as_of`` (default:
    today, as in the reference — pass a date for a reproducible table, Q7)."""
    ref = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    g = geolocation.select("zip_code_prefix", F.col("latitude").alias("customer_latitude"),
                           F.col("longitude").alias("customer_longitude"))
    j = rollup.join(g, "zip_code_prefix", "left")
    rev = F.col("lifetime_revenue")
    return j.select(
        surrogate_key("customer_unique_id").alias("customer_key"),
        "customer_unique_id", "customer_city", "customer_state", "zip_code_prefix",
        "customer_latitude", "customer_longitude", "total_orders", "delivered_orders", "first_order_at",
        "most_recent_order_at", "customer_tenure_days", "lifetime_revenue", "avg_order_value", "min_order_value",
        "max_order_value", "avg_review_score", "avg_delivery_delay_days", "customer_segment",
        F.when(rev >= 1000, "high_value").when(rev >= 200, "mid_value").otherwise("low_value").alias("clv_tier"),
        F.coalesce(F.col("most_recent_order_at") >= months_back(ref, 6).cast("timestamp_ntz"), F.lit(False))
        .alias("is_active"),
    )


def dim_sellers(rollup: DataFrame, geolocation: DataFrame) -> DataFrame:
    """M15: seller dimension with centroid, tier by score and tenure.  A seller
    without sales has a NULL score and so the lowest tier (Q8)."""
    g = geolocation.select("zip_code_prefix", F.col("latitude").alias("seller_latitude"),
                           F.col("longitude").alias("seller_longitude"))
    j = rollup.join(g, "zip_code_prefix", "left")
    s = F.col("seller_score")
    return j.select(
        surrogate_key("seller_id").alias("seller_key"),
        "seller_id", "seller_city", "seller_state", "zip_code_prefix", "seller_latitude", "seller_longitude",
        "total_orders", "total_items_sold", "distinct_products", "total_revenue", "avg_item_price",
        "total_freight_revenue", "delivered_orders", "on_time_deliveries", "on_time_rate_pct", "avg_delay_days",
        "avg_review_score", "review_count", "seller_score",
        F.when(s >= 80, "top_performer").when(s >= 60, "good").when(s >= 40, "average")
        .otherwise("needs_improvement").alias("seller_tier"),
        "first_sale_at", "most_recent_sale_at",
        day_diff("first_sale_at", "most_recent_sale_at").alias("seller_tenure_days"),
    )
