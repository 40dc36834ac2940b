"""Tables replaced together: one commit for a set, nothing seen of what was not committed."""

import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from martforge.sources import csv_ingest as ci
from martforge.sources.contracts import RAW_COLUMNS
from martforge.sources.snapshots import NotPublishedError, TableSet
from tests.conftest import SF_SMALL


def publish(tables, **frames):
    with tables.begin() as new:
        for name, df in frames.items():
            new.write(df, name)
        return new.commit()


def test_a_set_changes_as_one(spark, tmp_dir):
    lake = TableSet(spark, f"{tmp_dir}/marts")
    with pytest.raises(NotPublishedError):
        lake.read("a")
    publish(lake, a=spark.range(3), b=spark.range(4))
    with lake.begin() as new:
        new.write(spark.range(30), "a")
        assert lake.read("a").count() == 3  # written, not committed
        new.write(spark.range(40), "b")
        new.commit()
    assert (lake.read("a").count(), lake.read("b").count()) == (30, 40)
    assert lake.read("a", version=1).count() == 3
    publish(lake, b=spark.range(5))  # the others stay
    assert (lake.read("a").count(), lake.read("b").count()) == (30, 5)
    with lake.begin() as new:
        new.write(spark.range(1), "c")
        new.commit(whole=True)
    with pytest.raises(NotPublishedError):
        lake.read("a")


def test_a_failed_publication_leaves_the_set(spark, tmp_dir):
    lake = TableSet(spark, f"{tmp_dir}/marts")
    publish(lake, a=spark.range(3), b=spark.range(4))
    with pytest.raises(Exception):
        with lake.begin() as new:
            new.write(spark.range(30), "a")
            new.write(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), "b")
            new.commit()
    assert (lake.read("a").count(), lake.read("b").count()) == (3, 4)
    assert len(os.listdir(f"{tmp_dir}/marts/a")) == 1 and len(os.listdir(f"{tmp_dir}/marts/b")) == 1


def test_publishers_at_once_lose_no_commit(spark, tmp_dir):
    lake = TableSet(spark, f"{tmp_dir}/marts")
    one, two = lake.begin(), lake.begin()
    one.write(spark.range(1), "a")
    two.write(spark.range(2), "b")
    assert one.commit().version == 1
    assert two.commit().version == 2 and set(lake.current().tables) == {"a", "b"}
    # the number is taken between the look and the write
    three = lake.begin()
    three.write(spark.range(3), "c")
    real, taken = lake.files.create, []

    def create(file, text):
        if not taken:
            taken.append(file)
            other = lake.begin()
            other.write(spark.range(4), "d")
            other.commit()
        return real(file, text)

    lake.files.create = create
    assert three.commit().version == 4 and set(lake.current().tables) == {"a", "b", "c", "d"}


def test_an_incomplete_commit_does_not_count(spark, tmp_dir):
    lake = TableSet(spark, f"{tmp_dir}/marts")
    publish(lake, a=spark.range(3))
    with open(f"{tmp_dir}/marts/_commits/{2:020d}.json", "w") as f:
        f.write('{"version": 2, "tab')
    assert lake.current().version == 1 and lake.read("a").count() == 3
    assert publish(lake, a=spark.range(6)).version == 3 and lake.read("a").count() == 6


def test_empty_and_partitioned_tables_keep_their_schema(spark, tmp_dir):
    lake = TableSet(spark, f"{tmp_dir}/marts")
    with lake.begin() as new:
        new.write(spark.range(0).withColumn("k", F.lit("x")), "none", partition_by=["k"])
        new.write(spark.range(9).select(F.lit("2018").alias("y"), "id"), "years", partition_by=["y"])
        new.commit()
    assert lake.read("none").count() == 0 and lake.read("none").columns == ["id", "k"]
    assert lake.read("years").schema["y"].dataType.simpleString() == "string"


def test_expire_keeps_two_versions_and_running_publications(spark, tmp_dir):
    lake = TableSet(spark, f"{tmp_dir}/marts")
    for n in range(4):
        publish(lake, a=spark.range(n + 1), **({"b": spark.range(7)} if n == 0 else {}))
    running = lake.begin()
    running.write(spark.range(50), "a")
    lake.expire()
    assert lake.versions() == [4, 3] and lake.read("a", version=3).count() == 3 and lake.read("b").count() == 7
    assert len(os.listdir(f"{tmp_dir}/marts/a")) == 3
    running.commit()
    assert lake.read("a").count() == 50
    given_up = lake.begin()
    given_up.write(spark.range(60), "a")
    lake.expire(keep=1, grace_hours=0)
    assert os.listdir(f"{tmp_dir}/marts/a") == [running.id]


MARTS = ("fct_orders", "fct_revenue_daily", "dim_customers", "dim_sellers")


def test_a_build_killed_between_marts_leaves_the_old_set(spark, tmp_dir):
    """A process of its own builds two versions and dies after two marts of the second."""
    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {os.getcwd()!r})
        from martforge.plans import build as b
        from martforge.session import local_session
        from martforge.sources.snapshots import Publication
        from martforge.sources.testdata import raw_tables
        spark = local_session(cores=4, checkpoint={tmp_dir + "/ckpt"!r})
        raw = raw_tables(spark, {SF_SMALL!r})
        b.build(spark, raw, {tmp_dir + "/lake"!r}, as_of="2001-08-01", run_checks=False)
        b.concurrently = lambda *jobs: [job() for job in jobs]
        write, done = Publication.write, []

        def dying(self, df, name, **more):
            write(self, df, name, **more)
            if {tmp_dir + "/lake"!r} in self.set.root:
                done.append(name)
                if len(done) == 2:
                    print("dying after", done, flush=True)
                    os._exit(9)

        Publication.write = dying
        raw["orders"] = raw["orders"].limit(0)
        b.build(spark, raw, {tmp_dir + "/lake"!r}, as_of="2001-08-01", run_checks=False)
    """)
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert run.returncode == 9 and "dying after ['fct_orders', 'fct_revenue_daily']" in run.stdout, run.stderr[-2000:]
    from martforge.plans.build import build, read_marts
    from martforge.sources.testdata import raw_tables

    stored = read_marts(spark, f"{tmp_dir}/lake", "dev")
    assert set(stored) == set(MARTS) and len(os.listdir(f"{tmp_dir}/lake/dev_marts/fct_orders")) == 2
    counts = {name: df.count() for name, df in stored.items()}
    assert min(counts.values()) > 0
    again = build(spark, raw_tables(spark, SF_SMALL), f"{tmp_dir}/lake", as_of="2001-08-01", run_checks=False)
    assert again.version == 2 and {name: df.count() for name, df in again.tables.items()} == counts


def _csv(tmp_dir, **rows):
    for t, cols in RAW_COLUMNS.items():
        os.makedirs(f"{tmp_dir}/in", exist_ok=True)
        if t in rows or not os.path.exists(f"{tmp_dir}/in/{t}.csv"):
            with open(f"{tmp_dir}/in/{t}.csv", "w") as f:
                f.write(",".join(cols) + "\n" + "".join(r + "\n" for r in rows.get(t, [])))


def test_a_failed_load_leaves_the_raw_tables(spark, tmp_dir):
    _csv(tmp_dir, sellers=["s1,01037,Rio,RJ"], product_category_name_translation=["a,b"])
    ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/lake/raw")
    _csv(tmp_dir, sellers=["s1,01037,Rio,RJ", "s2,01037,Rio,RJ"])
    with open(f"{tmp_dir}/in/orders.csv", "w") as f:
        f.write("order_id,nothing\n")
    with pytest.raises(ci.ContractError):
        ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/lake/raw")
    assert [r.seller_id for r in ci.loaded(spark, f"{tmp_dir}/lake/raw")["sellers"].collect()] == ["s1"]
    assert len(os.listdir(f"{tmp_dir}/lake/raw/sellers")) == 1
    _csv(tmp_dir, orders=[])
    tables, report = ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/lake/raw")
    assert tables["sellers"].count() == 2 and {r.table_name: r.rows_loaded for r in report.collect()}["sellers"] == 2


def test_unchanged_inputs_are_kept(spark, tmp_dir):
    _csv(tmp_dir, sellers=["s1,01037,Rio,RJ", "s2,x"], customers=["c1,u1,01037,Rio,RJ"])
    ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw")
    first = ci.loaded_keys(spark, f"{tmp_dir}/raw")
    _csv(tmp_dir, customers=["c1,u1,01037,Rio,RJ", "c2,u2,01037,Rio,RJ"])
    tables, report = ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw")
    second = ci.loaded_keys(spark, f"{tmp_dir}/raw")
    assert {t for t in first if first[t] != second[t]} == {"customers"}
    rep = {r.table_name: (r.rows_loaded, r.rows_rejected) for r in report.collect()}
    assert rep["sellers"] == (1, 1) and rep["customers"] == (2, 0) and tables["customers"].count() == 2
    ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw", refresh=True)
    third = ci.loaded_keys(spark, f"{tmp_dir}/raw")
    assert all(second[t] != third[t] for t in third)
    notes = json.load(open(f"{tmp_dir}/_commits/raw/{3:020d}.json"))
    assert notes["tables"]["sellers"]["loaded"] == 1


def test_staged_tables_follow_their_inputs_and_arguments(spark, tmp_dir):
    from martforge.plans.build import Staged, staged_models

    _csv(tmp_dir, sellers=["s1,01037,Rio,RJ"], orders=["o1,c1,delivered,2018-01-01 00:00:00,,,,"], customers=["c1,u1,01037,Rio,RJ"],
         order_items=["o1,1,p1,s1,2018-01-01 00:00:00,10,1"], order_payments=["o1,9,voucher,1,5", "o1,10,boleto,1,5"])

    def run(**args):
        ci.load_raw(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw")
        staged = Staged(spark, f"{tmp_dir}/staged")
        tables = staged_models(spark, ci.loaded(spark, f"{tmp_dir}/raw"), "2018-06-01", staged=staged,
                               keys=ci.loaded_keys(spark, f"{tmp_dir}/raw"), **args)
        return staged, tables

    everything = {"orders_enriched", "stg_geolocation", "customer_rollup", "seller_rollup"}
    assert set(run()[0].made) == everything
    assert run()[0].made == []
    _csv(tmp_dir, sellers=["s1,01037,Rio,RJ", "s2,01037,Rio,RJ"])
    staged, tables = run()
    assert staged.made == ["seller_rollup"] and tables["seller_rollup"].count() == 2
    staged, tables = run(numeric_payment_order=True)
    assert set(staged.made) == everything - {"stg_geolocation"}
    assert tables["orders_enriched"].first().primary_payment_type == "boleto"
    assert run()[1]["orders_enriched"].first().primary_payment_type == "voucher"  # the other argument's copy is still there
    _csv(tmp_dir, geolocation=["01037,-23.5,-46.6,rio,RJ"])
    staged, tables = run()
    assert staged.made == ["stg_geolocation"] and tables["dim_sellers"].filter("seller_latitude IS NOT NULL").count() == 2
    staged.sweep(hours=0)
    assert {name: len(os.listdir(f"{tmp_dir}/staged/{name}")) for name in everything} == dict.fromkeys(everything, 1)
    assert run()[0].made == []
