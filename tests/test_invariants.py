"""Whole-pipeline invariants on the test data."""

import pytest
from pyspark.sql import functions as F

from martforge.plans.graph import models
from martforge.sources.testdata import raw_tables
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def m(spark):
    return models(raw_tables(spark, SF_SMALL), as_of="2001-08-01")


def test_revenue_conserved(m):
    items = m["stg_order_items"].join(m["stg_orders"].select("order_id"), "order_id", "left_semi")
    a = items.agg(F.sum(F.col("total_item_revenue").cast("decimal(18,2)"))).first()[0]
    b = m["fct_orders"].agg(F.sum(F.col("order_gross_revenue").cast("decimal(18,2)"))).first()[0]
    assert a == b


def test_cumulative_ends_at_total(m):
    daily = m["fct_revenue_daily"].collect()
    total = sum(round(r.gross_revenue * 100) for r in daily)
    assert round(daily[-1].revenue_cumulative * 100) == total


def test_grains(m):
    assert m["fct_orders"].count() == m["stg_orders"].count()
    persons = (m["orders_enriched"].join(m["stg_customers"], "customer_id").select("customer_unique_id")
               .distinct().count())
    assert m["dim_customers"].count() == persons
    assert m["dim_sellers"].count() == m["stg_sellers"].count()
    assert m["fct_revenue_daily"].select("revenue_date").distinct().count() == m["fct_revenue_daily"].count()
