"""DuckDB oracle for the ingest/sink queries."""

from __future__ import annotations

import duck_oracle as oracle

_TABLES = {
    "customers": "raw_customers", "geolocation": "raw_geolocation", "order_items": "raw_order_items",
    "order_payments": "raw_order_payments", "order_reviews": "raw_order_reviews", "orders": "raw_orders",
    "products": "raw_products", "sellers": "raw_sellers", "product_category_name_translation": "raw_translation",
}

_GOOD = "doc_id % 50 NOT IN (3, 7)"
_DIRTY = f"""
SELECT 'R' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS review_id, 'O' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS order_id,
  CAST(doc_id % 5 + 1 AS VARCHAR) AS review_score,
  CASE WHEN doc_id % 3 = 0 THEN 'say "' || doc_id || '", ok' END AS review_comment_title,
  nullif(text, '') AS review_comment_message, '2018-01-02 03:04:05' AS review_creation_date,
  CAST(NULL AS VARCHAR) AS review_answer_timestamp,
  (SELECT count(*) FROM documents WHERE {_GOOD}) AS n_good, (SELECT count(*) FROM documents WHERE NOT ({_GOOD})) AS n_rejected
FROM documents WHERE {_GOOD}"""

_REPORT = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected FROM {v}"
    for t, v in _TABLES.items())

SQL = {
    "csv_ingest_orders": oracle.with_models("SELECT * FROM raw_orders"),
    "csv_ingest_reviews": oracle.with_models(
        "SELECT review_id, order_id, review_score, review_comment_title, review_comment_message, "
        "nullif(review_creation_date, '') AS review_creation_date, review_answer_timestamp FROM raw_order_reviews"),
    "load_report": oracle.with_models(_REPORT),
    "load_report_dirty": oracle.with_models(
        f"SELECT * FROM ({_REPORT}) WHERE table_name <> 'order_reviews' UNION ALL SELECT 'order_reviews', "
        f"count(*) FILTER ({_GOOD}), count(*) FILTER (NOT ({_GOOD})) FROM documents"),
    "csv_ingest_dirty": _DIRTY,
    "input_presence": "SELECT t AS table_name, t IN ('orders', 'customers') AS present FROM (VALUES "
                      + ", ".join(f"('{t}')" for t in _TABLES) + ") v(t)",
    "build_revenue_daily": oracle.model_sql("fct_revenue_daily"),
}
