"""Staging models M1-M8: rename, clean, type.  Each is a lazy projection of one
raw table (M6 adds a lookup join, M8 a roll-up to one row per zip)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import (
    blank_to_null, clean_lower, clean_upper, day_diff, hour_diff, round_half_up,
    surrogate_key, to_double, to_int, to_timestamp, volumetric_weight,
)
from martforge.operators.aggregates import modes_per_key

COORD = "decimal(24,10)"


def stg_customers(raw: DataFrame) -> DataFrame:
    """M1: order-scoped customer id plus the person id; city and state cleaned."""
    return raw.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        clean_lower("customer_city").alias("customer_city"),
        clean_upper("customer_state").alias("customer_state"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """M2: status, five timestamps, three day differences (delay = actual -
    estimated; negative is early)."""
    purchased = to_timestamp("order_purchase_timestamp")
    delivered = to_timestamp("order_delivered_customer_date")
    estimated = to_timestamp("order_estimated_delivery_date")
    return raw.select(
        "order_id",
        "customer_id",
        clean_lower("order_status").alias("order_status"),
        purchased.alias("purchased_at"),
        to_timestamp("order_approved_at").alias("approved_at"),
        to_timestamp("order_delivered_carrier_date").alias("delivered_to_carrier_at"),
        delivered.alias("delivered_to_customer_at"),
        estimated.alias("estimated_delivery_at"),
        day_diff(purchased, delivered).alias("actual_delivery_days"),
        day_diff(purchased, estimated).alias("estimated_delivery_days"),
        day_diff(estimated, delivered).alias("delivery_delay_days"),
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    """M3: one row per item; key from (order_id, order_item_id)."""
    price, freight = to_double("price"), to_double("freight_value")
    return raw.select(
        surrogate_key("order_id", "order_item_id").alias("order_item_key"),
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        to_timestamp("shipping_limit_date").alias("shipping_limit_at"),
        price.alias("item_price"),
        freight.alias("freight_value"),
        (price + freight).alias("total_item_revenue"),
    )


def stg_order_payments(raw: DataFrame) -> DataFrame:
    """M4: one row per payment; ``payment_sequential`` stays text."""
    return raw.select(
        "order_id",
        "payment_sequential",
        clean_lower("payment_type").alias("payment_type"),
        to_int("payment_installments").alias("payment_installments"),
        to_double("payment_value").alias("payment_amount"),
    )


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """M5: score, blank text to NULL, hours from creation to answer."""
    created = to_timestamp("review_creation_date")
    answered = to_timestamp("review_answer_timestamp")
    return raw.select(
        "review_id",
        "order_id",
        to_int("review_score").alias("review_score"),
        blank_to_null("review_comment_title").alias("review_title"),
        blank_to_null("review_comment_message").alias("review_message"),
        created.alias("review_created_at"),
        answered.alias("review_answered_at"),
        hour_diff(created, answered).alias("response_time_hours"),
    )


def stg_products(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """M6: English category (``unknown`` when untranslated), sizes, volumetric
    weight.  The translation side is a small lookup; the planner broadcasts it
    when its measured size is under the broadcast threshold."""
    t = translation.select(
        F.col("product_category_name").alias("__pt"), F.col("product_category_name_english").alias("__en")
    )
    p = raw.join(t, raw["product_category_name"] == t["__pt"], "left")
    length, width, height = to_double("product_length_cm"), to_double("product_width_cm"), to_double(
        "product_height_cm")
    return p.select(
        "product_id",
        F.col("product_category_name").alias("category_name_pt"),
        F.coalesce(F.col("__en"), F.lit("unknown")).alias("category_name_en"),
        to_int("product_name_lenght").alias("name_length"),
        to_int("product_description_lenght").alias("description_length"),
        to_int("product_photos_qty").alias("photos_count"),
        to_double("product_weight_g").alias("weight_g"),
        length.alias("length_cm"),
        height.alias("height_cm"),
        width.alias("width_cm"),
        volumetric_weight(length, width, height).alias("volumetric_weight_g"),
    )


def stg_sellers(raw: DataFrame) -> DataFrame:
    """M7: sellers with cleaned city and state."""
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        clean_lower("seller_city").alias("seller_city"),
        clean_upper("seller_state").alias("seller_state"),
    )


def stg_geolocation(raw: DataFrame) -> DataFrame:
    """M8: one row per zip prefix — centroid (average, 6 decimals) and the
    most common city and state, from one scan in one two-level aggregation
    (``modes_per_key``); no join, so a NULL zip stays a group of its own."""
    g = raw.select(
        F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"),
        to_double("geolocation_lat").alias("lat"),
        to_double("geolocation_lng").alias("lng"),
        clean_lower("geolocation_city").alias("city"),
        clean_upper("geolocation_state").alias("state"),
    )
    m = modes_per_key(g, "zip_code_prefix", {"city": F.col("city"), "state": F.col("state")},
                      {"lat": F.col("lat").cast(COORD), "lng": F.col("lng").cast(COORD)})

    def centroid(axis: str):
        return round_half_up(F.col(f"{axis}_sum").cast("double") / F.nullif(F.col(f"{axis}_count"), F.lit(0)), 6)

    return m.select("zip_code_prefix", centroid("lat").alias("latitude"), centroid("lng").alias("longitude"),
                    "city", "state")


def staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All eight staging models from the nine raw tables."""
    return {
        "stg_customers": stg_customers(raw["customers"]),
        "stg_orders": stg_orders(raw["orders"]),
        "stg_order_items": stg_order_items(raw["order_items"]),
        "stg_order_payments": stg_order_payments(raw["order_payments"]),
        "stg_order_reviews": stg_order_reviews(raw["order_reviews"]),
        "stg_products": stg_products(raw["products"], raw["product_category_name_translation"]),
        "stg_sellers": stg_sellers(raw["sellers"]),
        "stg_geolocation": stg_geolocation(raw["geolocation"]),
    }
