"""The 81 data checks on the models (data only; DQ1-DQ4 instances).

Fixed values: which model/column carries which check, and the accepted
value lists.  Order follows the model layers.
"""

from __future__ import annotations

from martforge.operators.checks import Suite

ORDER_STATUSES = ("delivered", "shipped", "canceled", "invoiced", "processing", "approved", "unavailable", "created")
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
REVIEW_SCORES = (1, 2, 3, 4, 5)
CUSTOMER_SEGMENTS = ("one_time", "occasional", "repeat")
CLV_TIERS = ("high_value", "mid_value", "low_value")
SELLER_TIERS = ("top_performer", "good", "average", "needs_improvement")

NN, U = "not_null", "unique"


def av(values):
    return ("accepted_values", tuple(values))


def rel(model, field):
    return ("relationships", (), model, field)


def model_suite() -> Suite:
    s = Suite()
    # staging
    s.add("stg_customers", "customer_id", NN, U)
    s.add("stg_customers", "customer_unique_id", NN)
    s.add("stg_customers", "customer_state", NN)
    s.add("stg_orders", "order_id", NN, U)
    s.add("stg_orders", "customer_id", NN, rel("stg_customers", "customer_id"))
    s.add("stg_orders", "order_status", NN, av(ORDER_STATUSES))
    s.add("stg_orders", "purchased_at", NN)
    s.add("stg_order_items", "order_item_key", NN, U)
    s.add("stg_order_items", "order_id", NN, rel("stg_orders", "order_id"))
    s.add("stg_order_items", "product_id", NN, rel("stg_products", "product_id"))
    s.add("stg_order_items", "seller_id", NN, rel("stg_sellers", "seller_id"))
    s.add("stg_order_items", "item_price", NN)
    s.add("stg_order_items", "freight_value", NN)
    s.add("stg_order_payments", "order_id", NN, rel("stg_orders", "order_id"))
    s.add("stg_order_payments", "payment_type", NN, av(PAYMENT_TYPES))
    s.add("stg_order_payments", "payment_amount", NN)
    s.add("stg_order_reviews", "review_id", NN)
    s.add("stg_order_reviews", "order_id", NN)
    s.add("stg_order_reviews", "review_score", NN, av(REVIEW_SCORES))
    s.add("stg_products", "product_id", NN, U)
    s.add("stg_products", "category_name_en", NN)
    s.add("stg_sellers", "seller_id", NN, U)
    s.add("stg_sellers", "seller_state", NN)
    s.add("stg_geolocation", "zip_code_prefix", NN, U)
    # intermediate
    s.add("orders_enriched", "order_id", NN, U)
    s.add("orders_enriched", "order_gross_revenue", NN)
    s.add("orders_enriched", "order_status", NN)
    s.add("customer_rollup", "customer_unique_id", NN, U)
    s.add("customer_rollup", "total_orders", NN)
    s.add("customer_rollup", "lifetime_revenue", NN)
    s.add("seller_rollup", "seller_id", NN, U)
    # marts
    s.add("fct_orders", "order_key", NN, U)
    s.add("fct_orders", "order_id", NN, U)
    s.add("fct_orders", "customer_unique_id", NN)
    s.add("fct_orders", "order_status", NN, av(ORDER_STATUSES))
    s.add("fct_orders", "purchase_date", NN)
    s.add("fct_orders", "order_gross_revenue", NN)
    s.add("fct_orders", "item_count", NN)
    s.add("fct_orders", "primary_payment_type", av(PAYMENT_TYPES))
    s.add("fct_orders", "review_score", av(REVIEW_SCORES))
    s.add("fct_revenue_daily", "revenue_date", NN, U)
    s.add("fct_revenue_daily", "gross_revenue", NN)
    s.add("fct_revenue_daily", "orders_count", NN)
    s.add("dim_customers", "customer_key", NN, U)
    s.add("dim_customers", "customer_unique_id", NN, U)
    s.add("dim_customers", "total_orders", NN)
    s.add("dim_customers", "lifetime_revenue", NN)
    s.add("dim_customers", "customer_segment", NN, av(CUSTOMER_SEGMENTS))
    s.add("dim_customers", "clv_tier", NN, av(CLV_TIERS))
    s.add("dim_sellers", "seller_key", NN, U)
    s.add("dim_sellers", "seller_id", NN, U)
    s.add("dim_sellers", "seller_tier", NN, av(SELLER_TIERS))
    s.add("dim_sellers", "total_revenue", NN)
    return s
