"""Hand-made dirty CSVs (FIXTURES.md §4) -> load -> full build -> golden rows."""

import datetime as dt
import os

import pytest

from martforge.plans.build import build
from martforge.sources import csv_ingest as ci

BOM = "﻿"

FILES = {
    "orders": BOM + (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1, Delivered ,2018-01-01 10:00:00,NULL,2018-01-02 10:00:00,2018-01-12 09:00:00,2018-01-11 00:00:00\n"
        "o2,c2,delivered,2018-01-05 08:00:00,,,2018-01-10 08:00:00,2018-01-11 00:00:00\n"
        "o3,c3,SHIPPED,2018-02-01 00:00:00,N/A,NA,null,2018-02-20 00:00:00\n"
        "o4,c9,delivered,not a date,,,2018-03-01 00:00:00,2018-03-05 00:00:00\n"
        "o5,c1,delivered,2018-01-01 12:00:00,,,2018-01-03 00:00:00,2018-01-11 00:00:00,EXTRA\n"
    ),
    "customers": (
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        'c1,u1,01037,"Rio de Janeiro, RJ",rj\n'
        "c2,u1,02000, São Paulo ,sp\n"
        "c3,u2,NA,Santos,sp\n"
    ),
    "order_items": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,2018-01-03 00:00:00,100.00,10.00\n"
        "o2,1,p1,s2,,300.00,20.50\n"
        "o2,2,p2,s2,,300.00,20.50\n"
        "o2,3,p2,s2,,300.00,20.50\n"
    ),
    "order_payments": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,9,boleto,1,60.00\n"
        "o1,10, Voucher ,3,50.00\n"
        "o2,1,credit_card,2,981.50\n"
    ),
    "order_reviews": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
        "review_answer_timestamp\n"
        "r1,o1,2,,\"bad, \"\"late\"\"\nvery late\",NA,\n"
        "r2,o1,5,   ,ok,2018-01-02 00:00:00,2018-01-02 01:01:00\n"
        "r3,o2,4,Nice,\"fine\",2018-01-11 00:59:00,2018-01-11 01:01:00\n"
    ),
    "products": (
        "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
        "product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p1,moveis,1.6,100,2,500,20,5,10\n"
        "p2,nada,10,200,1,300,null,5,10\n"
    ),
    "sellers": (
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
        "s1,01037, Rio ,rj\n"
        "s2,99999,Curitiba,pr\n"
        "s3,01037,Niteroi,rj\n"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
        "01037,-22.9,-43.2,rio,RJ\n"
        "01037,-22.7,-43.4,Rio ,rj\n"
        "01037,-22.8,-43.3,niteroi,RJ\n"
        "02000,-23.5,-46.6,sao paulo,SP\n"
    ),
    "product_category_name_translation": BOM + (
        "product_category_name,product_category_name_english\n"
        "moveis,furniture\n"
    ),
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("golden"))
    for name, text in FILES.items():
        os.makedirs(f"{base}/in", exist_ok=True)
        with open(f"{base}/in/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    tables, report = ci.load_raw(spark, f"{base}/in", f"{base}/lake/raw")
    res = build(spark, tables, f"{base}/lake", as_of="2018-06-01")
    return {
        "report": {r.table_name: (r.rows_loaded, r.rows_rejected) for r in report.collect()},
        "checks": {r.check_name: r.failures for r in res.checks.filter("not passed").collect()},
        **{name: df.collect() for name, df in res.tables.items()},
    }


def test_load_report_counts_the_malformed_order(built):
    rep = built["report"]
    assert rep["orders"] == (4, 1)
    assert rep["order_reviews"] == (3, 0)  # the multi-line quoted review is one row
    assert rep["customers"] == (3, 0) and rep["product_category_name_translation"] == (1, 0)


def test_orders_fact(built):
    f = {r.order_id: r for r in built["fct_orders"]}
    assert set(f) == {"o1", "o2", "o3", "o4"}
    o1 = f["o1"]
    assert (o1.order_status, o1.is_late_delivery, o1.delivery_delay_days) == ("delivered", True, 1)
    assert (o1.customer_city, o1.customer_state, o1.customer_unique_id) == ("rio de janeiro, rj", "RJ", "u1")
    assert (o1.primary_payment_type, o1.total_payment_amount, o1.max_installments) == ("boleto", 110.0, 3)
    assert (o1.review_score, o1.review_response_hours, o1.is_positive_review) == (2, None, False)
    assert o1.purchase_month == dt.datetime(2018, 1, 1) and o1.order_gross_revenue == 110.0
    o3 = f["o3"]
    assert (o3.order_status, o3.delivered_to_customer_at, o3.item_count, o3.order_gross_revenue) == \
        ("shipped", None, 0, 0.0)
    assert f["o4"].purchased_at is None and f["o4"].customer_unique_id is None


def test_daily_revenue(built):
    days = built["fct_revenue_daily"]
    assert [d.revenue_date for d in days] == [dt.date(2018, 1, 1), dt.date(2018, 1, 5), None]
    d1, d2, dn = days
    assert (d1.orders_count, d1.gross_revenue, d1.late_deliveries, d1.credit_card_orders) == (1, 110.0, 1, 0)
    assert (d2.orders_count, d2.items_sold, d2.gross_revenue, d2.credit_card_orders) == (1, 3, 961.5, 1)
    assert d2.revenue_7d_avg == 535.75 and d2.revenue_mtd == 1071.5 and d2.revenue_cumulative == 1071.5
    assert (dn.orders_count, dn.gross_revenue, dn.revenue_cumulative) == (1, 0.0, 1071.5)


def test_customer_dimension(built):
    c = {r.customer_unique_id: r for r in built["dim_customers"]}
    u1 = c["u1"]
    assert (u1.total_orders, u1.customer_segment, u1.customer_city, u1.zip_code_prefix) == \
        (2, "occasional", "são paulo", "02000")
    assert (u1.lifetime_revenue, u1.clv_tier, u1.is_active) == (1071.5, "high_value", True)  # 2018-01-05 >= 2017-12-01
    assert (u1.customer_latitude, u1.customer_longitude) == (-23.5, -46.6)
    u2 = c["u2"]
    assert (u2.zip_code_prefix, u2.customer_latitude, u2.clv_tier) == (None, None, "low_value")


def test_seller_dimension(built):
    s = {r.seller_id: r for r in built["dim_sellers"]}
    assert (s["s2"].total_orders, s["s2"].total_items_sold, s["s2"].distinct_products) == (1, 3, 2)
    assert (s["s2"].on_time_rate_pct, s["s2"].avg_review_score) == (300.0, 4.0)
    assert (s["s1"].seller_city, s["s1"].seller_latitude, s["s1"].seller_longitude) == ("rio", -22.8, -43.3)
    assert (s["s3"].seller_tier, s["s3"].total_revenue, s["s3"].seller_score) == ("needs_improvement", None, None)


def test_failing_checks(built):
    assert built["checks"] == {
        "not_null_stg_orders_purchased_at": 1,
        "relationships_stg_orders_customer_id__stg_customers_customer_id": 1,
        "not_null_fct_orders_customer_unique_id": 1,
        "not_null_fct_orders_purchase_date": 1,
        "not_null_fct_revenue_daily_revenue_date": 1,
        "not_null_dim_sellers_total_revenue": 1,
    }
