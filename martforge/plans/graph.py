"""The model graph wired together (REF1): raw tables -> every model, lazily."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from martforge.plans import marts, rollups, staging


def models(raw: dict[str, DataFrame], as_of: dt.date | str | None = None,
           numeric_payment_order: bool = False) -> dict[str, DataFrame]:
    """All fifteen models, lazily; M9 is planned inline in each consumer.
    ``plans.build.staged_models`` is the variant that materialises the shared
    intermediates once.  ``numeric_payment_order`` ranks payment sequences as
    numbers instead of text for the primary payment type (Q1)."""
    s = staging.staging(raw)
    children = (s["stg_orders"], s["stg_order_items"], s["stg_order_payments"], s["stg_order_reviews"])
    m9 = rollups.orders_enriched(*children, numeric_payment_order, review_text=False)
    m10 = rollups.customer_rollup(m9, s["stg_customers"])
    m11 = rollups.seller_rollup(s["stg_order_items"], m9, s["stg_sellers"])
    out = dict(s)
    out.update({
        "orders_enriched": rollups.orders_enriched(*children, numeric_payment_order),
        "customer_rollup": m10,
        "seller_rollup": m11,
        "fct_orders": marts.fct_orders(m9, s["stg_customers"]),
        "fct_revenue_daily": marts.fct_revenue_daily(m9),
        "dim_customers": marts.dim_customers(m10, s["stg_geolocation"], as_of),
        "dim_sellers": marts.dim_sellers(m11, s["stg_geolocation"]),
    })
    return out
