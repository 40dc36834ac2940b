"""The command line: load -> run -> test over a lake folder."""

from martforge.__main__ import main
from martforge.io_queries import write_csv
from martforge.sources.testdata import raw_tables
from tests.conftest import SF_SMALL


def test_load_run_test(spark, tmp_dir, capsys):
    for name, df in raw_tables(spark, SF_SMALL).items():
        write_csv(df, f"{tmp_dir}/in/{name}.csv")
    assert main(["load", "--input", f"{tmp_dir}/in", "--lake", f"{tmp_dir}/lake"]) == 0
    assert "total loaded" in capsys.readouterr().out
    assert main(["run", "--lake", f"{tmp_dir}/lake", "--as-of", "2001-08-01"]) == 0
    assert main(["test", "--lake", f"{tmp_dir}/lake", "--as-of", "2001-08-01"]) == 1  # seeded failures
    out = capsys.readouterr().out
    assert "74 passed, 7 failed" in out and "FAIL not_null_stg_orders_purchased_at (16)" in out
    assert main(["test", "--lake", f"{tmp_dir}/lake", "--as-of", "2001-08-01", "--select", "fct_orders"]) == 1
    out = capsys.readouterr().out
    assert "10 passed, 2 failed" in out and "stg_orders" not in out
    assert main(["test", "--lake", f"{tmp_dir}/lake", "--select", "dim_sellers,stg_products"]) == 1
    assert "9 passed, 1 failed" in capsys.readouterr().out  # 7 + 3 checks


def test_load_reports_missing_inputs(spark, tmp_dir, capsys):
    assert main(["load", "--input", f"{tmp_dir}/nothing", "--lake", f"{tmp_dir}/lake"]) == 2
    err = capsys.readouterr().err
    assert "missing raw inputs" in err and "order_reviews" in err and "product_category_name_translation" in err


def test_run_rejects_unknown_marts(spark, tmp_dir, capsys):
    assert main(["run", "--lake", f"{tmp_dir}/lake", "--select", "fct_nothing"]) == 2
    assert "unknown marts" in capsys.readouterr().err
