"""CSV files -> load -> full build -> stored marts equal the lazy models."""

from martforge.plans.build import build
from martforge.plans.graph import models
from martforge.sources import csv_ingest as ci
from martforge.sources.testdata import raw_tables
from tests.conftest import SF_SMALL


def test_csv_build_round_trip(spark, tmp_dir):
    raw = raw_tables(spark, SF_SMALL)
    for name, df in raw.items():
        (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("quote", '"').option("escape", '"')
         .csv(f"{tmp_dir}/csv/{name}.csv"))
    tables, report = ci.load_raw(spark, f"{tmp_dir}/csv", f"{tmp_dir}/raw")
    assert {r.table_name: r.rows_rejected for r in report.collect()} == {t: 0 for t in raw}
    res = build(spark, tables, f"{tmp_dir}/out", as_of="2001-08-01")
    ref = models(raw, as_of="2001-08-01")
    for name, stored in res.tables.items():
        a, b = stored.select(*ref[name].columns), ref[name]
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    failing = {r.check_name: r.failures for r in res.checks.filter("not passed").collect()}
    assert failing == {
        "not_null_stg_orders_purchased_at": 16, "relationships_stg_orders_customer_id__stg_customers_customer_id": 5,
        "not_null_fct_orders_customer_unique_id": 5, "not_null_fct_orders_purchase_date": 16,
        "not_null_fct_revenue_daily_revenue_date": 1, "not_null_dim_sellers_total_revenue": 10,
        "relationships_stg_order_payments_order_id__stg_orders_order_id": 37,
    }


def test_build_can_register_every_model_as_a_view(spark, tmp_dir):
    res = build(spark, raw_tables(spark, SF_SMALL), f"{tmp_dir}/out", as_of="2001-08-01", run_checks=False,
                register_views=True)
    assert res.checks is None
    n = spark.sql("SELECT count(*) FROM fct_orders o JOIN dim_customers c USING (customer_unique_id)").first()[0]
    assert n > 0
    assert spark.sql("SELECT count(*) FROM stg_orders").first()[0] == spark.table("fct_orders").count()


def test_build_selected_marts_only(spark, tmp_dir):
    import os

    import pytest

    res = build(spark, raw_tables(spark, SF_SMALL), f"{tmp_dir}/out", as_of="2001-08-01", run_checks=False,
                marts=("fct_revenue_daily",))
    assert list(res.tables) == ["fct_revenue_daily"]
    assert os.listdir(f"{tmp_dir}/out/dev_marts") == ["fct_revenue_daily"]
    with pytest.raises(ValueError):
        build(spark, raw_tables(spark, SF_SMALL), f"{tmp_dir}/out2", run_checks=False, marts=("fct_nothing",))


def test_selected_build_stages_only_what_it_needs_and_leaves_nothing(spark, tmp_dir):
    import os

    from martforge.plans.build import Staged

    staged = Staged(spark, f"{tmp_dir}/staged")
    build(spark, raw_tables(spark, SF_SMALL), f"{tmp_dir}/out", as_of="2001-08-01", run_checks=False,
          marts=("fct_revenue_daily",), staged=staged)
    assert os.listdir(f"{tmp_dir}/staged") == ["orders_enriched"]
    m9 = staged.get("orders_enriched", None, staged.used["orders_enriched"])
    assert not {"review_title", "review_message"} & set(m9.columns)
    staged.delete()
    assert not os.path.exists(f"{tmp_dir}/staged")


def test_staged_intermediates_are_reused(spark, tmp_dir):
    import os

    from martforge.plans.build import Staged, staged_models

    staged = Staged(spark, f"{tmp_dir}/staged")
    raw = raw_tables(spark, SF_SMALL)
    staged_models(spark, raw, "2001-08-01", wanted=["fct_orders"], staged=staged)
    again = Staged(spark, f"{tmp_dir}/staged")
    tables = staged_models(spark, raw, "2001-08-01", wanted=["seller_rollup"], staged=again)
    assert again.used["orders_enriched"] == staged.used["orders_enriched"] and again.made == ["seller_rollup"]
    assert len(os.listdir(f"{tmp_dir}/staged/orders_enriched")) == 1
    assert "seller_rollup" in tables and "dim_sellers" not in tables


def test_a_failed_write_leaves_the_previous_table(spark, tmp_dir):
    import os

    import pytest
    from pyspark.sql import functions as F

    from martforge.sources.sinks import read_table, write_table

    path = f"{tmp_dir}/t"
    write_table(spark.range(5), path)
    with pytest.raises(Exception):
        write_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert read_table(spark, path).count() == 5
    write_table(spark.range(7), path)
    assert read_table(spark, path).count() == 7 and os.listdir(tmp_dir) == ["t"]


def test_months_prune_partitions(spark, tmp_dir, capsys):
    from martforge.plans.build import read_mart

    build(spark, raw_tables(spark, SF_SMALL), f"{tmp_dir}/out", as_of="2001-08-01", run_checks=False, marts=("fct_orders",))
    whole = read_mart(spark, f"{tmp_dir}/out", "dev", "fct_orders")
    month = whole.filter("purchase_month IS NOT NULL").selectExpr("date_format(min(purchase_month), 'yyyy-MM')").first()[0]
    one = read_mart(spark, f"{tmp_dir}/out", "dev", "fct_orders", months=[month])
    assert one.columns == whole.columns
    assert 0 < one.count() == whole.filter(f"date_format(purchase_month, 'yyyy-MM') = '{month}'").count() < whole.count()
    one.explain("formatted")
    filters = [x for x in capsys.readouterr().out.splitlines() if "PartitionFilters" in x]
    assert filters and all("purchase_month_key" in x for x in filters)
