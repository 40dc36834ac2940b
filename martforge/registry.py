"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Model queries run the whole model graph over the raw tables derived from the
test data; operator queries apply one generic operator to a test-data table.
Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martforge.plans.graph import models
from martforge.sources.testdata import BUILDERS, raw_tables

AS_OF = "2001-08-01"  # fixed `as_of` for is_active (Q7), so results are reproducible

MODEL_NAMES = [
    "stg_customers", "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews",
    "stg_products", "stg_sellers", "stg_geolocation", "orders_enriched", "customer_rollup", "seller_rollup",
    "fct_orders", "fct_revenue_daily", "dim_customers", "dim_sellers",
]

RAW_QUERY_NAMES = {
    "raw_customers": "customers", "raw_geolocation": "geolocation", "raw_order_items": "order_items",
    "raw_order_payments": "order_payments", "raw_order_reviews": "order_reviews", "raw_orders": "orders",
    "raw_products": "products", "raw_sellers": "sellers", "raw_translation": "product_category_name_translation",
}


def _model_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models(raw_tables(spark, sf_dir), as_of=AS_OF)[name]
    run.__name__ = name
    return run


def _raw_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return BUILDERS[table](spark, sf_dir)
    run.__name__ = f"raw_{table}"
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from martforge import check_queries, io_queries, operator_queries

    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for key, table in RAW_QUERY_NAMES.items():
        out[key] = _raw_query(table)
    for name in MODEL_NAMES:
        out[name] = _model_query(name)
    out.update(operator_queries.QUERIES)
    out.update(check_queries.QUERIES)
    out.update(io_queries.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    import duck_oracle as oracle
    from duck_oracle import checks as check_oracle, io as io_oracle, operators as op_oracle

    out = {key: oracle.with_models(f"SELECT * FROM {key}") for key in RAW_QUERY_NAMES}
    out.update({name: oracle.model_sql(name) for name in MODEL_NAMES})
    out.update(op_oracle.SQL)
    out.update(check_oracle.SQL)
    out.update(io_oracle.SQL)
    return out
