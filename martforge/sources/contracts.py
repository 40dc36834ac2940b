"""Declared raw sources (SRC1): nine header-named tables, every column text.

Fixed values: table names and the raw column names (with the header typo
``lenght`` as it is in the data).
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ],
    "geolocation": [
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
        "geolocation_state",
    ],
    "order_items": [
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ],
    "order_payments": [
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ],
    "order_reviews": [
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ],
    "orders": [
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ],
    "products": [
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "product_category_name_translation": ["product_category_name", "product_category_name_english"],
}

def default_path(base_dir: str, table: str) -> str:
    """Where a raw table is read from unless a path map is given:
    ``<base_dir>/<table>.csv`` (a file, a directory of part files or a glob)."""
    return f"{base_dir.rstrip('/')}/{table}.csv"


# Tables with free text that may hold quoted newlines; their records are found
# by ``quoted_csv``, the others' end at every newline.
MULTILINE_TABLES = {"order_reviews"}


def raw_schema(table: str) -> StructType:
    """All-text schema of a raw table, in header order."""
    return StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS[table]])
