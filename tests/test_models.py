"""Model semantics on hand-made raw tables (quirks Q1-Q13, FIXTURES §4)."""

import datetime as dt

import pytest

from martforge.plans.graph import models
from martforge.sources.contracts import RAW_COLUMNS, raw_schema


def raw(spark, table, rows):
    cols = RAW_COLUMNS[table]
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, raw_schema(table))


@pytest.fixture(scope="module")
def built(spark):
    orders = [
        # o1: delivered a day late, three items from one seller, early? no: late by 1
        dict(order_id="o1", customer_id="c1", order_status=" Delivered", order_purchase_timestamp="2018-01-01 10:00:00",
             order_delivered_customer_date="2018-01-12 09:00:00", order_estimated_delivery_date="2018-01-11 00:00:00"),
        # o2: delivered a day early; three items of seller s2 -> on-time rate 300 %
        dict(order_id="o2", customer_id="c2", order_status="delivered", order_purchase_timestamp="2018-01-05 08:00:00",
             order_delivered_customer_date="2018-01-10 08:00:00", order_estimated_delivery_date="2018-01-11 00:00:00"),
        # o3: no items, no payment, no review
        dict(order_id="o3", customer_id="c3", order_status="SHIPPED", order_purchase_timestamp="2018-02-01 00:00:00",
             order_estimated_delivery_date="2018-02-20 00:00:00"),
        # o4: unparsable purchase time, no customer row
        dict(order_id="o4", customer_id="c9", order_status="delivered", order_purchase_timestamp="not a date",
             order_delivered_customer_date="2018-03-01 00:00:00", order_estimated_delivery_date="2018-03-05 00:00:00"),
    ]
    customers = [
        dict(customer_id="c1", customer_unique_id="u1", customer_zip_code_prefix="01037", customer_city=" Rio ",
             customer_state="rj"),
        dict(customer_id="c2", customer_unique_id="u1", customer_zip_code_prefix="02000", customer_city="São Paulo ",
             customer_state="sp"),
        dict(customer_id="c3", customer_unique_id="u1", customer_zip_code_prefix="02000", customer_city="Santos",
             customer_state="sp"),
    ]
    items = [dict(order_id="o1", order_item_id="1", product_id="p1", seller_id="s1", price="100.00",
                  freight_value="10.00")] + [
        dict(order_id="o2", order_item_id=str(i), product_id=f"p{i}", seller_id="s2", price="300.00",
             freight_value="20.50") for i in (1, 2, 3)]
    payments = [dict(order_id="o1", payment_sequential="9", payment_type="boleto", payment_installments="1",
                     payment_value="60.00"),
                dict(order_id="o1", payment_sequential="10", payment_type=" Voucher", payment_installments="3",
                     payment_value="50.00")]
    reviews = [dict(review_id="r1", order_id="o1", review_score="2", review_creation_date=None),
               dict(review_id="r2", order_id="o1", review_score="5", review_creation_date="2018-01-02 00:00:00",
                    review_answer_timestamp="2018-01-02 01:01:00"),
               dict(review_id="r3", order_id="o2", review_score="4", review_comment_title="  ",
                    review_creation_date="2018-01-11 00:59:00", review_answer_timestamp="2018-01-11 01:01:00")]
    products = [dict(product_id="p1", product_category_name="moveis", product_length_cm="20", product_width_cm="10",
                     product_height_cm="5", product_name_lenght="1.6"),
                dict(product_id="p2", product_category_name="nada", product_length_cm=None, product_width_cm="10",
                     product_height_cm="5")]
    translation = [dict(product_category_name="moveis", product_category_name_english="furniture")]
    sellers = [dict(seller_id="s1", seller_zip_code_prefix="01037", seller_city=" X ", seller_state="sp"),
               dict(seller_id="s2", seller_zip_code_prefix="99999", seller_city="Y", seller_state="rj"),
               dict(seller_id="s3", seller_zip_code_prefix="01037", seller_city="Z", seller_state="mg")]
    geo = [dict(geolocation_zip_code_prefix="01037", geolocation_lat="-23.5", geolocation_lng="-46.6",
                geolocation_city=c, geolocation_state="sp") for c in ["b", "a", "a", "b", None, None, None]]
    tables = {
        "orders": raw(spark, "orders", orders), "customers": raw(spark, "customers", customers),
        "order_items": raw(spark, "order_items", items), "order_payments": raw(spark, "order_payments", payments),
        "order_reviews": raw(spark, "order_reviews", reviews), "products": raw(spark, "products", products),
        "product_category_name_translation": raw(spark, "product_category_name_translation", translation),
        "sellers": raw(spark, "sellers", sellers), "geolocation": raw(spark, "geolocation", geo),
    }
    return {k: {r[0]: r for r in v.collect()} if k not in ("fct_revenue_daily",) else v.collect()
            for k, v in models(tables, as_of="2018-06-01").items()}


def test_orders_staging(built):
    o = built["stg_orders"]
    assert o["o1"].order_status == "delivered" and o["o3"].order_status == "shipped"
    assert o["o1"].delivery_delay_days == 1 and o["o2"].delivery_delay_days == -1
    assert o["o4"].purchased_at is None and o["o4"].actual_delivery_days is None


def test_enriched_zero_fills_items_only(built):
    e = built["orders_enriched"]["o3"]
    assert (e.item_count, e.items_subtotal, e.order_gross_revenue, e.distinct_sellers) == (0, 0.0, 0.0, 0)
    assert e.total_payment_amount is None and e.primary_payment_type is None and e.review_score is None
    assert (e.is_delivered, e.is_late_delivery, e.is_positive_review) == (False, False, False)


def test_primary_payment_is_text_order_and_latest_review_null_first(built):
    e = built["orders_enriched"]["o1"]
    assert e.primary_payment_type == "boleto"  # '9' > '10' as text
    assert e.total_payment_amount == 110.0 and e.max_installments == 3
    assert e.review_score == 2 and e.review_response_hours is None  # NULL-dated review wins
    assert built["orders_enriched"]["o2"].review_response_hours == 1  # 00:59 -> 01:01
    assert built["stg_order_reviews"]["r3"].review_title is None


def test_person_rollup_across_orders_with_move(built):
    u = built["customer_rollup"]["u1"]
    assert u.total_orders == 3 and u.customer_segment == "occasional"
    assert u.customer_city == "santos" and u.zip_code_prefix == "02000"  # latest order
    assert u.lifetime_revenue == 110.0 + 961.5 and u.customer_tenure_days == 31
    d = built["dim_customers"]["dc" if False else next(iter(built["dim_customers"]))]
    assert d.clv_tier == "high_value" and d.is_active is True


def test_seller_rollup_item_weighted_and_no_sales(built):
    s2 = built["seller_rollup"]["s2"]
    assert (s2.total_orders, s2.total_items_sold, s2.on_time_deliveries) == (1, 3, 3)
    assert s2.on_time_rate_pct == 300.0
    s3 = built["dim_sellers"]
    s3 = [r for r in s3.values() if r.seller_id == "s3"][0]
    assert s3.seller_score is None and s3.seller_tier == "needs_improvement" and s3.total_revenue is None
    assert s3.seller_latitude == -23.5


def test_products_and_geolocation(built):
    p = built["stg_products"]
    assert p["p1"].category_name_en == "furniture" and p["p1"].volumetric_weight_g == 200.0
    assert p["p1"].name_length == 2  # '1.6' rounds
    assert p["p2"].category_name_en == "unknown" and p["p2"].volumetric_weight_g is None
    g = built["stg_geolocation"]["01037"]
    assert (g.city, g.state, g.latitude) == ("a", "SP", -23.5)


def test_daily_revenue_keeps_null_day_last(built):
    days = built["fct_revenue_daily"]
    assert [d.revenue_date for d in days] == [dt.date(2018, 1, 1), dt.date(2018, 1, 5), None]
    assert days[-1].revenue_cumulative == 110.0 + 961.5 + 0.0
    assert days[1].revenue_7d_avg == round((110.0 + 961.5) / 2, 2)


def test_numeric_payment_order_option(spark):
    cols = {t: raw(spark, t, []) for t in RAW_COLUMNS}
    cols["orders"] = raw(spark, "orders", [dict(order_id="o1", customer_id="c1", order_status="delivered")])
    cols["order_payments"] = raw(spark, "order_payments", [
        dict(order_id="o1", payment_sequential="9", payment_type="boleto", payment_value="1.00"),
        dict(order_id="o1", payment_sequential="10", payment_type="voucher", payment_value="1.00")])
    as_text = models(cols)["orders_enriched"].first().primary_payment_type
    as_number = models(cols, numeric_payment_order=True)["orders_enriched"].first().primary_payment_type
    assert (as_text, as_number) == ("boleto", "voucher")
