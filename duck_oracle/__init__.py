"""DuckDB SQL oracle for the correctness check.

The views ``region nation customer supplier part orders lineitem events ...``
are the test-data parquet tables.  ``ADAPTER`` derives the nine raw text
tables from them by the rules in FIXTURES.md §3, ``MODELS`` computes every
model from those, written independently in DuckDB SQL.  ``with_models(select)``
wraps a final SELECT with all the CTEs it may need (DuckDB inlines and prunes
unused CTEs).
"""

from __future__ import annotations

KEY_NULL = "_dbt_utils_surrogate_key_null_"  # fixed value
TS = "'%Y-%m-%d %H:%M:%S'"


def _pad(prefix: str, expr: str) -> str:
    return f"('{prefix}' || lpad(CAST({expr} AS VARCHAR), 8, '0'))"


def _money(expr: str) -> str:
    return f"(CAST(({expr}) // 100 AS VARCHAR) || '.' || lpad(CAST(({expr}) % 100 AS VARCHAR), 2, '0'))"


def _zip(expr: str) -> str:
    return f"lpad(CAST(({expr}) % 211 AS VARCHAR), 5, '0')"


def _st(expr: str) -> str:
    return f"substr('acalapambaceesdfgomamg', CAST(2 * (({expr}) % 11) + 1 AS INTEGER), 2)"


def _key(*exprs: str) -> str:
    parts = ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{KEY_NULL}')" for e in exprs)
    return f"md5(concat_ws('-', {parts}))"


def _round(expr: str, n: int) -> str:
    return f"CAST(round(CAST(({expr}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def _exact(decimal: str) -> str:
    """A wide decimal as the nearest double (a direct cast divides inexactly)."""
    return f"CAST(CAST({decimal} AS VARCHAR) AS DOUBLE)"


def _msum(expr: str, t: str = "DECIMAL(38,10)") -> str:
    return _exact(f"sum(CAST(CAST({expr} AS VARCHAR) AS {t}))")  # by text: the decimal that the double shows


def _mavg(expr: str, t: str = "DECIMAL(38,10)") -> str:
    return f"({_msum(expr, t)} / nullif(count({expr}), 0))"


def _iavg(expr: str) -> str:
    return f"(CAST(sum(CAST({expr} AS BIGINT)) AS DOUBLE) / nullif(count({expr}), 0))"


def _ddiff(a: str, b: str) -> str:
    return f"CAST(date_diff('day', CAST({a} AS DATE), CAST({b} AS DATE)) AS INTEGER)"


ADAPTER = {
    "raw_orders": f"""
SELECT {_pad('O', 'k')} AS order_id, {_pad('C', 'k')} AS customer_id,
  CASE k % 40 WHEN 1 THEN ' Shipped ' WHEN 2 THEN 'CANCELED' WHEN 3 THEN 'invoiced' WHEN 4 THEN 'processing'
    WHEN 5 THEN 'approved' WHEN 6 THEN 'unavailable' WHEN 7 THEN 'created' ELSE ' Delivered' END AS order_status,
  CASE WHEN k % 97 = 0 THEN 'not a date' ELSE strftime(p, {TS}) END AS order_purchase_timestamp,
  CASE WHEN k % 50 <> 0 THEN strftime(p + to_hours(CAST(k % 30 AS BIGINT)), {TS}) END AS order_approved_at,
  CASE WHEN k % 40 NOT BETWEEN 1 AND 7 THEN strftime(p + INTERVAL 2 DAY, {TS}) END AS order_delivered_carrier_date,
  CASE WHEN k % 40 NOT BETWEEN 1 AND 7 THEN strftime(p + to_days(CAST(5 + k % 20 + k % 11 AS INTEGER))
       + to_seconds(CAST(k % 86400 AS BIGINT)), {TS}) END AS order_delivered_customer_date,
  strftime(CAST(date_trunc('day', p) AS TIMESTAMP) + INTERVAL 20 DAY, {TS}) AS order_estimated_delivery_date
FROM (SELECT o_orderkey AS k, o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS BIGINT)) AS p FROM orders)""",
    "raw_customers": f"""
SELECT CASE WHEN k % 301 = 0 THEN {_pad('Z', 'k')} ELSE {_pad('C', 'k')} END AS customer_id, {_pad('U', 'q')} AS customer_unique_id,
  CASE WHEN q % 53 <> 0 THEN {_zip('v')} END AS customer_zip_code_prefix,
  '  City ' || CAST(v % 211 AS VARCHAR) AS customer_city, {_st('v')} AS customer_state
FROM (SELECT k, q, q + (k // 6) % 2 AS v
      FROM (SELECT o_orderkey AS k, o_custkey * 10 + o_orderkey % 6 AS q FROM orders))""",
    "raw_order_items": f"""
SELECT {_pad('O', 'l_orderkey')} AS order_id,
  concat_ws('-', l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS order_item_id,
  {_pad('P', 'l_partkey')} AS product_id, {_pad('S', 'l_suppkey * 21 + l_orderkey % 20')} AS seller_id,
  strftime(l_shipdate, {TS}) AS shipping_limit_date,
  {_money('(l_partkey * 37 + l_suppkey * 11 + CAST(l_quantity AS BIGINT) * 101) % 30000 + 100')} AS price,
  {_money('(l_partkey + CAST(l_quantity AS BIGINT) * 7) % 4000')} AS freight_value
FROM lineitem""",
    "raw_order_payments": f"""
SELECT CASE WHEN k % 83 = 0 THEN {_pad('Y', 'k')} ELSE {_pad('O', 'k')} END AS order_id, CAST(i AS VARCHAR) AS payment_sequential,
  CASE (k + i) % 5 WHEN 0 THEN 'Credit_Card ' WHEN 1 THEN ' boleto' WHEN 2 THEN 'VOUCHER' WHEN 3 THEN 'debit_card'
    ELSE 'not_defined' END AS payment_type,
  CAST((k + i) % 10 + 1 AS VARCHAR) AS payment_installments,
  {_money('(k * 31 + i * 97) % 50000 + 1')} AS payment_value
FROM (SELECT k, unnest(range(1, n + 1)) AS i
      FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 12 + 1 ELSE 1 END AS n
            FROM orders))""",
    "raw_order_reviews": f"""
SELECT {_pad('R', 'event_id // 2')} AS review_id, {_pad('O', 'n')} AS order_id,
  CAST(CASE WHEN event_id % 7 = 0 THEN user_id % 5 + 1 ELSE 5 - (n % 20) // 4 END AS VARCHAR) AS review_score,
  CASE event_id % 3 WHEN 1 THEN '   ' WHEN 2 THEN ' ok ' END AS review_comment_title,
  ' ' || event_type AS review_comment_message,
  CASE WHEN event_id % 41 = 0 THEN '' ELSE strftime(ts, {TS}) END AS review_creation_date,
  strftime(ts + to_minutes(CAST(user_id * 17 AS BIGINT)), {TS}) AS review_answer_timestamp
FROM (SELECT *, event_id - CASE WHEN event_id % 3 = 0 AND event_id > 0 THEN 1 ELSE 0 END AS n FROM events)""",
    "raw_products": f"""
SELECT {_pad('P', 'p_partkey')} AS product_id,
  CASE WHEN p_partkey % 61 <> 0 THEN lower(p_type) END AS product_category_name,
  CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
  CAST(p_size * 10 AS VARCHAR) AS product_description_lenght,
  CAST(p_size % 6 AS VARCHAR) AS product_photos_qty,
  CAST(p_size * 50 AS VARCHAR) AS product_weight_g,
  CASE WHEN p_partkey % 71 <> 0 THEN CAST(p_size AS VARCHAR) END AS product_length_cm,
  CAST(p_size % 17 + 1 AS VARCHAR) AS product_height_cm,
  CAST(p_size % 23 + 1 AS VARCHAR) AS product_width_cm
FROM part""",
    "raw_translation": """
SELECT CASE WHEN name = (SELECT min(lower(p_type)) FROM part) THEN 'x_' || name ELSE name END AS product_category_name,
  'en_' || name AS product_category_name_english
FROM (SELECT DISTINCT lower(p_type) AS name FROM part)""",
    "raw_sellers": f"""
SELECT {_pad('S', 's')} AS seller_id, {_zip('s')} AS seller_zip_code_prefix,
  ' City ' || CAST(s % 211 AS VARCHAR) AS seller_city, {_st('s')} AS seller_state
FROM (SELECT s_suppkey * 21 + unnest(range(0, 21)) AS s FROM supplier)""",
    "raw_geolocation": f"""
SELECT CASE WHEN c_custkey % 211 = 7 THEN 'V' || {_zip('c_custkey')} ELSE {_zip('c_custkey')} END AS geolocation_zip_code_prefix,
  '-' || CAST(10 + c_custkey % 20 AS VARCHAR) || '.' || lpad(CAST((c_custkey * 13) % 1000 AS VARCHAR), 3, '0')
    AS geolocation_lat,
  '-' || CAST(40 + c_custkey % 20 AS VARCHAR) || '.' || lpad(CAST((c_custkey * 29) % 1000 AS VARCHAR), 3, '0')
    AS geolocation_lng,
  'City' || CAST(c_nationkey % 3 AS VARCHAR) AS geolocation_city, {_st('c_nationkey')} AS geolocation_state
FROM customer""",
}

AS_OF = "2001-08-01"

MODELS = {
    "stg_customers": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
  lower(trim(customer_city)) AS customer_city, upper(trim(customer_state)) AS customer_state
FROM raw_customers""",
    "stg_orders": f"""
SELECT order_id, customer_id, order_status, purchased_at, approved_at, delivered_to_carrier_at,
  delivered_to_customer_at, estimated_delivery_at,
  {_ddiff('purchased_at', 'delivered_to_customer_at')} AS actual_delivery_days,
  {_ddiff('purchased_at', 'estimated_delivery_at')} AS estimated_delivery_days,
  {_ddiff('estimated_delivery_at', 'delivered_to_customer_at')} AS delivery_delay_days
FROM (SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
        try_cast(order_purchase_timestamp AS TIMESTAMP) AS purchased_at,
        try_cast(order_approved_at AS TIMESTAMP) AS approved_at,
        try_cast(order_delivered_carrier_date AS TIMESTAMP) AS delivered_to_carrier_at,
        try_cast(order_delivered_customer_date AS TIMESTAMP) AS delivered_to_customer_at,
        try_cast(order_estimated_delivery_date AS TIMESTAMP) AS estimated_delivery_at
      FROM raw_orders)""",
    "stg_order_items": f"""
SELECT {_key('order_id', 'order_item_id')} AS order_item_key, order_id, order_item_id, product_id, seller_id,
  try_cast(shipping_limit_date AS TIMESTAMP) AS shipping_limit_at,
  CAST(price AS DOUBLE) AS item_price, CAST(freight_value AS DOUBLE) AS freight_value,
  CAST(price AS DOUBLE) + CAST(freight_value AS DOUBLE) AS total_item_revenue
FROM raw_order_items""",
    "stg_order_payments": """
SELECT order_id, payment_sequential, lower(trim(payment_type)) AS payment_type,
  CAST(payment_installments AS INTEGER) AS payment_installments, CAST(payment_value AS DOUBLE) AS payment_amount
FROM raw_order_payments""",
    "stg_order_reviews": """
SELECT review_id, order_id, review_score, review_title, review_message, review_created_at, review_answered_at,
  CAST(date_diff('hour', review_created_at, review_answered_at) AS BIGINT) AS response_time_hours
FROM (SELECT review_id, order_id, CAST(review_score AS INTEGER) AS review_score,
        nullif(trim(review_comment_title), '') AS review_title,
        nullif(trim(review_comment_message), '') AS review_message,
        try_cast(review_creation_date AS TIMESTAMP) AS review_created_at,
        try_cast(review_answer_timestamp AS TIMESTAMP) AS review_answered_at
      FROM raw_order_reviews)""",
    "stg_products": f"""
SELECT p.product_id, p.product_category_name AS category_name_pt,
  coalesce(t.product_category_name_english, 'unknown') AS category_name_en,
  CAST(p.product_name_lenght AS INTEGER) AS name_length,
  CAST(p.product_description_lenght AS INTEGER) AS description_length,
  CAST(p.product_photos_qty AS INTEGER) AS photos_count,
  CAST(p.product_weight_g AS DOUBLE) AS weight_g,
  CAST(p.product_length_cm AS DOUBLE) AS length_cm,
  CAST(p.product_height_cm AS DOUBLE) AS height_cm,
  CAST(p.product_width_cm AS DOUBLE) AS width_cm,
  {_round('CAST(p.product_length_cm AS DOUBLE) * CAST(p.product_width_cm AS DOUBLE) * CAST(p.product_height_cm AS DOUBLE) / CAST(5000.0 AS DOUBLE) * 1000', 2)} AS volumetric_weight_g
FROM raw_products p LEFT JOIN raw_translation t ON p.product_category_name = t.product_category_name""",
    "stg_sellers": """
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, lower(trim(seller_city)) AS seller_city,
  upper(trim(seller_state)) AS seller_state
FROM raw_sellers""",
    "geo_clean": """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, CAST(geolocation_lat AS DOUBLE) AS lat,
  CAST(geolocation_lng AS DOUBLE) AS lng, lower(trim(geolocation_city)) AS city,
  upper(trim(geolocation_state)) AS state
FROM raw_geolocation""",
    "stg_geolocation": f"""
SELECT c.zip_code_prefix, c.latitude, c.longitude, mc.city, ms.state
FROM (SELECT zip_code_prefix, {_round(_mavg('lat', 'DECIMAL(24,10)'), 6)} AS latitude,
        {_round(_mavg('lng', 'DECIMAL(24,10)'), 6)} AS longitude
      FROM geo_clean GROUP BY zip_code_prefix) c
LEFT JOIN (SELECT zip_code_prefix, city FROM (
      SELECT zip_code_prefix, city,
        row_number() OVER (PARTITION BY zip_code_prefix ORDER BY count(*) DESC, city ASC) AS rn
      FROM geo_clean WHERE city IS NOT NULL GROUP BY zip_code_prefix, city) WHERE rn = 1) mc
  ON c.zip_code_prefix IS NOT DISTINCT FROM mc.zip_code_prefix
LEFT JOIN (SELECT zip_code_prefix, state FROM (
      SELECT zip_code_prefix, state,
        row_number() OVER (PARTITION BY zip_code_prefix ORDER BY count(*) DESC, state ASC) AS rn
      FROM geo_clean WHERE state IS NOT NULL GROUP BY zip_code_prefix, state) WHERE rn = 1) ms
  ON c.zip_code_prefix IS NOT DISTINCT FROM ms.zip_code_prefix""",
    "orders_enriched": f"""
SELECT o.order_id, o.customer_id, o.order_status, o.purchased_at, o.approved_at, o.delivered_to_carrier_at,
  o.delivered_to_customer_at, o.estimated_delivery_at, o.actual_delivery_days, o.estimated_delivery_days,
  o.delivery_delay_days, coalesce(o.delivery_delay_days > 0, false) AS is_late_delivery,
  coalesce(oi.item_count, 0) AS item_count,
  coalesce(oi.items_subtotal, CAST(0 AS DOUBLE)) AS items_subtotal,
  coalesce(oi.freight_total, CAST(0 AS DOUBLE)) AS freight_total,
  coalesce(oi.order_gross_revenue, CAST(0 AS DOUBLE)) AS order_gross_revenue,
  coalesce(oi.distinct_sellers, 0) AS distinct_sellers,
  op.total_payment_amount, op.max_installments, op.primary_payment_type,
  r.review_score, r.review_title, r.review_message, r.response_time_hours AS review_response_hours,
  coalesce(o.order_status = 'delivered', false) AS is_delivered,
  coalesce(r.review_score >= 4, false) AS is_positive_review
FROM stg_orders o
LEFT JOIN (SELECT order_id, count(*) AS item_count, {_msum('item_price')} AS items_subtotal,
             {_msum('freight_value')} AS freight_total, {_msum('total_item_revenue')} AS order_gross_revenue,
             count(DISTINCT seller_id) AS distinct_sellers
           FROM stg_order_items GROUP BY order_id) oi ON o.order_id = oi.order_id
LEFT JOIN (SELECT order_id, {_msum('payment_amount')} AS total_payment_amount,
             max(payment_installments) AS max_installments,
             arg_max_null(payment_type, CASE WHEN payment_sequential IS NOT NULL
               THEN {{'s': payment_sequential, 't': payment_type}} END) AS primary_payment_type
           FROM stg_order_payments GROUP BY order_id) op ON o.order_id = op.order_id
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id
             ORDER BY review_created_at DESC NULLS FIRST, review_id DESC NULLS LAST,
                      review_score DESC NULLS LAST, response_time_hours DESC NULLS LAST,
                      review_title DESC NULLS LAST, review_message DESC NULLS LAST) AS rn
           FROM stg_order_reviews) WHERE rn = 1) r ON o.order_id = r.order_id""",
    "customer_rollup": f"""
SELECT customer_unique_id, customer_city, customer_state, zip_code_prefix, total_orders, delivered_orders,
  lifetime_revenue, avg_order_value, min_order_value, max_order_value, first_order_at, most_recent_order_at,
  {_ddiff('first_order_at', 'most_recent_order_at')} AS customer_tenure_days,
  avg_review_score, avg_delivery_delay_days,
  CASE WHEN total_orders = 1 THEN 'one_time' WHEN total_orders BETWEEN 2 AND 3 THEN 'occasional'
       ELSE 'repeat' END AS customer_segment
FROM (SELECT c.customer_unique_id,
        arg_max_null(c.customer_city, CASE WHEN o.purchased_at IS NOT NULL
          THEN {{'p': o.purchased_at, 'o': o.order_id}} END) AS customer_city,
        arg_max_null(c.customer_state, CASE WHEN o.purchased_at IS NOT NULL
          THEN {{'p': o.purchased_at, 'o': o.order_id}} END) AS customer_state,
        arg_max_null(c.zip_code_prefix, CASE WHEN o.purchased_at IS NOT NULL
          THEN {{'p': o.purchased_at, 'o': o.order_id}} END) AS zip_code_prefix,
        count(o.order_id) AS total_orders, count(*) FILTER (WHERE o.is_delivered) AS delivered_orders,
        {_msum('o.order_gross_revenue')} AS lifetime_revenue, {_mavg('o.order_gross_revenue')} AS avg_order_value,
        min(o.order_gross_revenue) AS min_order_value, max(o.order_gross_revenue) AS max_order_value,
        min(o.purchased_at) AS first_order_at, max(o.purchased_at) AS most_recent_order_at,
        {_iavg('o.review_score')} AS avg_review_score, {_iavg('o.delivery_delay_days')} AS avg_delivery_delay_days
      FROM orders_enriched o JOIN stg_customers c ON o.customer_id = c.customer_id
      GROUP BY c.customer_unique_id)""",
    "seller_metrics": f"""
SELECT *, {_round('''coalesce(avg_review_score, CAST(3 AS DOUBLE)) / CAST(5 AS DOUBLE) * 100 * CAST(0.40 AS DOUBLE)
    + on_time_rate_pct * CAST(0.40 AS DOUBLE)
    + least(ln(CAST(total_orders AS DOUBLE) + 1) / ln(CAST(1000 AS DOUBLE)) * 100, CAST(100 AS DOUBLE))
      * CAST(0.20 AS DOUBLE)''', 2)} AS seller_score
FROM (SELECT *, {_round('CAST(on_time_deliveries AS DOUBLE) / nullif(total_orders, 0) * 100', 2)} AS on_time_rate_pct
      FROM (SELECT i.seller_id, count(DISTINCT i.order_id) AS total_orders, count(*) AS total_items_sold,
              count(DISTINCT i.product_id) AS distinct_products,
              {_msum('i.total_item_revenue')} AS total_revenue, {_mavg('i.item_price')} AS avg_item_price,
              {_msum('i.freight_value')} AS total_freight_revenue,
              count(*) FILTER (WHERE o.is_delivered) AS delivered_orders,
              CAST(sum(CASE WHEN o.delivery_delay_days <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_deliveries,
              {_iavg('o.delivery_delay_days')} AS avg_delay_days, {_iavg('o.review_score')} AS avg_review_score,
              count(o.review_score) AS review_count,
              min(o.purchased_at) AS first_sale_at, max(o.purchased_at) AS most_recent_sale_at
            FROM stg_order_items i JOIN orders_enriched o ON i.order_id = o.order_id
            GROUP BY i.seller_id))""",
    "seller_rollup": """
SELECT s.seller_id, s.seller_city, s.seller_state, s.zip_code_prefix, m.total_orders, m.total_items_sold,
  m.distinct_products, m.total_revenue, m.avg_item_price, m.total_freight_revenue, m.delivered_orders,
  m.on_time_deliveries, m.avg_delay_days, m.on_time_rate_pct, m.avg_review_score, m.review_count,
  m.seller_score, m.first_sale_at, m.most_recent_sale_at
FROM stg_sellers s LEFT JOIN seller_metrics m ON s.seller_id = m.seller_id""",
    "fct_orders": f"""
SELECT {_key('o.order_id')} AS order_key, o.order_id, o.customer_id, c.customer_unique_id, o.order_status,
  o.is_delivered, o.is_late_delivery, o.purchased_at,
  CAST(date_trunc('day', o.purchased_at) AS TIMESTAMP) AS purchase_date,
  CAST(date_trunc('month', o.purchased_at) AS TIMESTAMP) AS purchase_month,
  CAST(date_trunc('year', o.purchased_at) AS TIMESTAMP) AS purchase_year,
  o.delivered_to_customer_at, c.customer_city, c.customer_state, o.item_count, o.distinct_sellers,
  o.items_subtotal, o.freight_total, o.order_gross_revenue, o.total_payment_amount, o.primary_payment_type,
  o.max_installments, o.actual_delivery_days, o.estimated_delivery_days, o.delivery_delay_days,
  o.review_score, o.is_positive_review, o.review_response_hours
FROM orders_enriched o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id""",
    "daily_metrics": f"""
SELECT CAST(purchased_at AS DATE) AS revenue_date, count(order_id) AS orders_count,
  CAST(sum(item_count) AS BIGINT) AS items_sold,
  {_msum('order_gross_revenue')} AS gross_revenue, {_msum('items_subtotal')} AS product_revenue,
  {_msum('freight_total')} AS freight_revenue, {_mavg('order_gross_revenue')} AS avg_order_value,
  count(*) FILTER (WHERE primary_payment_type = 'credit_card') AS credit_card_orders,
  count(*) FILTER (WHERE primary_payment_type = 'boleto') AS boleto_orders,
  count(*) FILTER (WHERE primary_payment_type = 'voucher') AS voucher_orders,
  {_iavg('review_score')} AS avg_review_score,
  count(*) FILTER (WHERE is_positive_review) AS positive_reviews,
  count(*) FILTER (WHERE is_late_delivery) AS late_deliveries,
  {_iavg('delivery_delay_days')} AS avg_delay_days
FROM orders_enriched WHERE is_delivered GROUP BY 1""",
    "fct_revenue_daily": f"""
SELECT *,
  {_round(_exact('sum(CAST(CAST(gross_revenue AS VARCHAR) AS DECIMAL(38,10))) OVER w7') + ' / count(gross_revenue) OVER w7', 2)}
    AS revenue_7d_avg,
  {_exact("""sum(CAST(CAST(gross_revenue AS VARCHAR) AS DECIMAL(38,10))) OVER (PARTITION BY date_trunc('month', revenue_date)
    ORDER BY revenue_date ASC NULLS LAST)""")} AS revenue_mtd,
  {_exact('sum(CAST(CAST(gross_revenue AS VARCHAR) AS DECIMAL(38,10))) OVER (ORDER BY revenue_date ASC NULLS LAST)')}
    AS revenue_cumulative
FROM daily_metrics
WINDOW w7 AS (ORDER BY revenue_date ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "dim_customers": f"""
SELECT {_key('c.customer_unique_id')} AS customer_key, c.customer_unique_id, c.customer_city, c.customer_state,
  c.zip_code_prefix, g.latitude AS customer_latitude, g.longitude AS customer_longitude, c.total_orders,
  c.delivered_orders, c.first_order_at, c.most_recent_order_at, c.customer_tenure_days, c.lifetime_revenue,
  c.avg_order_value, c.min_order_value, c.max_order_value, c.avg_review_score, c.avg_delivery_delay_days,
  c.customer_segment,
  CASE WHEN c.lifetime_revenue >= 1000 THEN 'high_value' WHEN c.lifetime_revenue >= 200 THEN 'mid_value'
       ELSE 'low_value' END AS clv_tier,
  coalesce(c.most_recent_order_at >= CAST(CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE) AS TIMESTAMP), false)
    AS is_active
FROM customer_rollup c LEFT JOIN stg_geolocation g ON c.zip_code_prefix = g.zip_code_prefix""",
    "dim_sellers": f"""
SELECT {_key('s.seller_id')} AS seller_key, s.seller_id, s.seller_city, s.seller_state, s.zip_code_prefix,
  g.latitude AS seller_latitude, g.longitude AS seller_longitude, s.total_orders, s.total_items_sold,
  s.distinct_products, s.total_revenue, s.avg_item_price, s.total_freight_revenue, s.delivered_orders,
  s.on_time_deliveries, s.on_time_rate_pct, s.avg_delay_days, s.avg_review_score, s.review_count,
  s.seller_score,
  CASE WHEN s.seller_score >= 80 THEN 'top_performer' WHEN s.seller_score >= 60 THEN 'good'
       WHEN s.seller_score >= 40 THEN 'average' ELSE 'needs_improvement' END AS seller_tier,
  s.first_sale_at, s.most_recent_sale_at,
  {_ddiff('s.first_sale_at', 's.most_recent_sale_at')} AS seller_tenure_days
FROM seller_rollup s LEFT JOIN stg_geolocation g ON s.zip_code_prefix = g.zip_code_prefix""",
}

RAW_ALIASES = {
    "raw_customers": "customers", "raw_geolocation": "geolocation", "raw_order_items": "order_items",
    "raw_order_payments": "order_payments", "raw_order_reviews": "order_reviews", "raw_orders": "orders",
    "raw_products": "products", "raw_sellers": "sellers", "raw_translation": "product_category_name_translation",
}


def with_models(select: str) -> str:
    """``WITH <adapter>, <models> <select>``."""
    ctes = [f"{name} AS ({sql.strip()})" for name, sql in ADAPTER.items()]
    ctes += [f"{name} AS ({sql.strip()})" for name, sql in MODELS.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + select


def model_sql(name: str) -> str:
    return with_models(f"SELECT * FROM {name}")
