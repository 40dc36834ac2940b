"""CSV ingest IO1-IO7: dialect, NULL tokens, quarantine, contract, missing files."""

import os

import pytest

from martforge.sources import csv_ingest as ci
from martforge.sources.contracts import RAW_COLUMNS

DIRTY = (
    "﻿seller_id, seller_zip_code_prefix,seller_city,seller_state\n"
    '1,"x, ""q""\nline2",NULL,ok\n'
    "2,,NA,\n"
    '3,"",N/A,x\n'
    "4,only\n"
    "5,1,2,3,4\n"
    "01037,null,ok,SP\n"
)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_dialect_tokens_and_quarantine(spark, tmp_dir):
    p = f"{tmp_dir}/sellers.csv"
    write(p, DIRTY)
    df = ci.read_raw_csv(spark, "sellers", p, multiline=True)
    assert df.columns == RAW_COLUMNS["sellers"] + ["_bad"]
    good = sorted([tuple(r) for r in ci.good_rows(df).collect()], key=str)
    assert good == sorted([("1", 'x, "q"\nline2', None, "ok"), ("2", None, None, None), ("3", None, None, "x"),
                           ("01037", None, "ok", "SP")], key=str)
    bad = sorted(r["_bad"] for r in df.filter("_bad is not null").select("seller_id", "_bad").collect())
    assert bad == ["4,only", "5,1,2,3,4"]


def test_narrow_projection_still_rejects_malformed_rows(spark, tmp_dir):
    p = f"{tmp_dir}/sellers.csv"
    write(p, DIRTY.replace('"x, ""q""\nline2"', '"x, ""q"""'))
    good = ci.good_rows(ci.read_raw_csv(spark, "sellers", p))
    assert len(good.collect()) == len(good.select("seller_id").collect()) == 4


def test_header_contract(spark, tmp_dir):
    p = f"{tmp_dir}/sellers.csv"
    write(p, "seller_id,zip,seller_city,seller_state\n1,2,3,4\n")
    with pytest.raises(ci.ContractError):
        ci.read_raw_csv(spark, "sellers", p)
    q = f"{tmp_dir}/s2/sellers.csv"
    write(q, "seller_state,seller_city,seller_zip_code_prefix,seller_id\nSP,c,01037,s9\n")
    row = ci.good_rows(ci.read_raw_csv(spark, "sellers", q)).first()
    assert tuple(row) == ("s9", "01037", "c", "SP")  # header order, contract output order


def test_every_part_file_header_is_checked(spark, tmp_dir):
    head = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    write(f"{tmp_dir}/ok/sellers.csv/part-1.csv", head + "1,01037,a,SP\n")
    write(f"{tmp_dir}/ok/sellers.csv/part-2.csv", head + "2,02000,b,RJ\n")
    rows = ci.good_rows(ci.read_raw_csv(spark, "sellers", f"{tmp_dir}/ok/sellers.csv")).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "01037", "a", "SP"), ("2", "02000", "b", "RJ")]
    write(f"{tmp_dir}/bad/sellers.csv/part-1.csv", head + "1,01037,a,SP\n")
    write(f"{tmp_dir}/bad/sellers.csv/part-2.csv",
          "seller_state,seller_city,seller_zip_code_prefix,seller_id\nRJ,b,02000,2\n")
    with pytest.raises(Exception):  # read out of place otherwise
        ci.good_rows(ci.read_raw_csv(spark, "sellers", f"{tmp_dir}/bad/sellers.csv")).collect()


def test_missing_inputs_listed_together(spark, tmp_dir):
    write(f"{tmp_dir}/sellers.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
    with pytest.raises(ci.MissingInputError) as e:
        ci.check_inputs(spark, {"sellers": f"{tmp_dir}/sellers.csv", "orders": f"{tmp_dir}/orders.csv",
                                "customers": f"{tmp_dir}/customers.csv"})
    assert "orders" in str(e.value) and "customers" in str(e.value) and "sellers:" not in str(e.value)


def test_load_raw_writes_once_and_reports(spark, tmp_dir):
    base = f"{tmp_dir}/in"
    for t, cols in RAW_COLUMNS.items():
        write(f"{base}/{t}.csv", ",".join(cols) + "\n")
    write(f"{base}/sellers.csv", DIRTY.replace('"x, ""q""\nline2"', '"x, ""q"""'))
    tables, report = ci.load_raw(spark, base, f"{tmp_dir}/raw")
    rep = {r.table_name: (r.rows_loaded, r.rows_rejected) for r in report.collect()}
    assert rep["sellers"] == (4, 2) and rep["orders"] == (0, 0)
    assert len(tables["sellers"].collect()) == 4
    (load,) = os.listdir(f"{tmp_dir}/raw/sellers")
    assert os.path.isdir(f"{tmp_dir}/raw/sellers/{load}/_status=rejected")


def test_windows_line_endings(spark, tmp_dir):
    p = f"{tmp_dir}/order_reviews.csv"
    with open(p, "w", encoding="utf-8", newline="") as f:
        f.write(",".join(RAW_COLUMNS["order_reviews"]) + "\r\n"
                + 'r1,o1,2,,"bad, ""late""\r\nvery late",2018-01-01 00:00:00,2018-01-02 01:01:00\r\n'
                + "r2,o1,5,t,ok,2018-01-02 00:00:00,2018-01-02 01:01:00\r\n")
    rows = sorted(tuple(r) for r in ci.good_rows(ci.read_raw_csv(spark, "order_reviews", p)).collect())
    assert rows[0][4] == 'bad, "late"\nvery late' and rows[0][6] == "2018-01-02 01:01:00"  # no trailing CR
    assert rows[1][6] == "2018-01-02 01:01:00"
