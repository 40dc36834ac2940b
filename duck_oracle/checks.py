"""DuckDB oracle for the data-check queries."""

from __future__ import annotations

import duck_oracle as oracle

# The checks as the SQL side states them, on its own: model, column, kind, and
# the accepted values or the parent column.
RULES = """
stg_customers customer_id not_null
stg_customers customer_id unique
stg_customers customer_unique_id not_null
stg_customers customer_state not_null
stg_orders order_id not_null
stg_orders order_id unique
stg_orders customer_id not_null
stg_orders customer_id relationships stg_customers.customer_id
stg_orders order_status not_null
stg_orders order_status accepted_values delivered,shipped,canceled,invoiced,processing,approved,unavailable,created
stg_orders purchased_at not_null
stg_order_items order_item_key not_null
stg_order_items order_item_key unique
stg_order_items order_id not_null
stg_order_items order_id relationships stg_orders.order_id
stg_order_items product_id not_null
stg_order_items product_id relationships stg_products.product_id
stg_order_items seller_id not_null
stg_order_items seller_id relationships stg_sellers.seller_id
stg_order_items item_price not_null
stg_order_items freight_value not_null
stg_order_payments order_id not_null
stg_order_payments order_id relationships stg_orders.order_id
stg_order_payments payment_type not_null
stg_order_payments payment_type accepted_values credit_card,boleto,voucher,debit_card,not_defined
stg_order_payments payment_amount not_null
stg_order_reviews review_id not_null
stg_order_reviews order_id not_null
stg_order_reviews review_score not_null
stg_order_reviews review_score accepted_values 1,2,3,4,5
stg_products product_id not_null
stg_products product_id unique
stg_products category_name_en not_null
stg_sellers seller_id not_null
stg_sellers seller_id unique
stg_sellers seller_state not_null
stg_geolocation zip_code_prefix not_null
stg_geolocation zip_code_prefix unique
orders_enriched order_id not_null
orders_enriched order_id unique
orders_enriched order_gross_revenue not_null
orders_enriched order_status not_null
customer_rollup customer_unique_id not_null
customer_rollup customer_unique_id unique
customer_rollup total_orders not_null
customer_rollup lifetime_revenue not_null
seller_rollup seller_id not_null
seller_rollup seller_id unique
fct_orders order_key not_null
fct_orders order_key unique
fct_orders order_id not_null
fct_orders order_id unique
fct_orders customer_unique_id not_null
fct_orders order_status not_null
fct_orders order_status accepted_values delivered,shipped,canceled,invoiced,processing,approved,unavailable,created
fct_orders purchase_date not_null
fct_orders order_gross_revenue not_null
fct_orders item_count not_null
fct_orders primary_payment_type accepted_values credit_card,boleto,voucher,debit_card,not_defined
fct_orders review_score accepted_values 1,2,3,4,5
fct_revenue_daily revenue_date not_null
fct_revenue_daily revenue_date unique
fct_revenue_daily gross_revenue not_null
fct_revenue_daily orders_count not_null
dim_customers customer_key not_null
dim_customers customer_key unique
dim_customers customer_unique_id not_null
dim_customers customer_unique_id unique
dim_customers total_orders not_null
dim_customers lifetime_revenue not_null
dim_customers customer_segment not_null
dim_customers customer_segment accepted_values one_time,occasional,repeat
dim_customers clv_tier not_null
dim_customers clv_tier accepted_values high_value,mid_value,low_value
dim_sellers seller_key not_null
dim_sellers seller_key unique
dim_sellers seller_id not_null
dim_sellers seller_id unique
dim_sellers seller_tier not_null
dim_sellers seller_tier accepted_values top_performer,good,average,needs_improvement
dim_sellers total_revenue not_null
"""
ORDER_STATUSES = "delivered,shipped,canceled,invoiced,processing,approved,unavailable,created".split(",")


def _lit_list(values) -> str:
    return ", ".join("'" + str(v) + "'" for v in values)


def _check_sql(rule: str) -> str:
    model, column, kind, *more = rule.split(" ")
    if kind == "relationships":
        parent, key = more[0].split(".")
        name = f"relationships_{model}_{column}__{parent}_{key}"
    else:
        name = f"{kind}_{model}_{column}"
    head = (f"SELECT '{model}' AS model, '{column}' AS column_name, '{kind}' AS test, '{name}' AS check_name, "
            "CAST(count(*) AS BIGINT) AS failures")
    if kind == "not_null":
        return f"{head} FROM {model} WHERE {column} IS NULL"
    if kind == "unique":
        return f"{head} FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
    if kind == "accepted_values":
        return (f"{head} FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL AND "
                f"CAST({column} AS VARCHAR) NOT IN ({_lit_list(more[0].split(','))}) GROUP BY {column})")
    return (f"{head} FROM {model} ch LEFT JOIN {parent} pa ON ch.{column} = pa.{key} "
            f"WHERE ch.{column} IS NOT NULL AND pa.{key} IS NULL")


SUITE = " UNION ALL ".join(f"({_check_sql(c)})" for c in RULES.strip().split("\n"))

SQL = {
    "check_not_null": oracle.with_models("SELECT * FROM stg_orders WHERE purchased_at IS NULL"),
    "check_unique": oracle.with_models(
        "SELECT review_id AS value, count(*) AS n_records FROM stg_order_reviews WHERE review_id IS NOT NULL "
        "GROUP BY review_id HAVING count(*) > 1"),
    "check_accepted_values": oracle.with_models(
        "SELECT order_status AS value, count(*) AS n_records FROM raw_orders WHERE order_status IS NOT NULL "
        f"AND order_status NOT IN ({_lit_list(ORDER_STATUSES)}) GROUP BY order_status"),
    "check_relationships": oracle.with_models(
        "SELECT o.customer_id AS value, count(*) AS n_records FROM stg_orders o "
        "LEFT JOIN stg_customers c ON o.customer_id = c.customer_id "
        "WHERE o.customer_id IS NOT NULL AND c.customer_id IS NULL GROUP BY o.customer_id"),
    "check_suite": oracle.with_models(f"SELECT *, failures = 0 AS passed FROM ({SUITE})"),
}
