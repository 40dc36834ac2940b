"""Bench: headline work at $BENCH_SF_DIR on local[$BENCH_CPUS].

Follows the production flow: the nine raw tables (derived from the test data)
land in storage once — as ``load_raw`` does for CSV — as ``$BENCH_CPUS`` files
each (a landing zone holds many files; a single small file would be a single
scan task), and every model, the check suite and the full build read them.  Also timed: one query end to end
from the test-data tables.  Each query is forced to completion with the
``noop`` sink (full computation, nothing collected); the full build writes
real parquet to a fresh scratch folder.  An untimed warm-up runs first.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martforge import registry  # noqa: E402
from martforge.operators.checks import run_suite  # noqa: E402
from martforge.plans.build import build, concurrently, staged_models  # noqa: E402
from martforge.plans.graph import models  # noqa: E402
from martforge.plans.rules import model_suite  # noqa: E402
from martforge.session import checkpoint_dir, local_session  # noqa: E402
from martforge.sources.testdata import raw_tables  # noqa: E402

MODELS = ["orders_enriched", "customer_rollup", "seller_rollup", "fct_orders", "fct_revenue_daily",
          "dim_customers", "dim_sellers"]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="martforge-bench-", dir="/tmp")
    spark = local_session(cores=cpus, shuffle_partitions=max(8, cpus), app="martforge-bench",
                          checkpoint=f"{scratch}/checkpoints")
    checkpoint_dir(spark)
    times: dict[str, float] = {}
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))

    def timed(name, fn, runs=None):
        best = None
        for _ in range(runs or repeat):
            t0 = time.perf_counter()
            fn()
            took = time.perf_counter() - t0
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)

    run_noop(registry.queries()["fct_revenue_daily"](spark, sf_dir))  # warm-up, untimed

    timed("e2e_fct_revenue_daily", lambda: run_noop(registry.queries()["fct_revenue_daily"](spark, sf_dir)))

    def ingest():
        # A landing zone holds many files; at this size a table would be one
        # file with one row group (one scan task), so land it as `cpus` files.
        jobs = [lambda n=n, df=df: df.repartition(cpus).write.mode("overwrite").parquet(f"{scratch}/raw/{n}")
                for n, df in raw_tables(spark, sf_dir).items()]
        concurrently(*jobs)
    timed("ingest_raw", ingest, runs=1)

    # CSV ingest (the loader entry point): the raw tables as CSV files
    # (untimed), then load_raw timed — dialect, NULL tokens, header checks,
    # quarantine split, parquet write and load report.
    from martforge.io_queries import write_csv
    from martforge.sources.csv_ingest import load_raw
    concurrently(*[lambda n=n, df=df: write_csv(df.repartition(cpus), f"{scratch}/csv/{n}.csv")
                   for n, df in raw_tables(spark, sf_dir).items()])
    timed("load_csv", lambda: load_raw(spark, f"{scratch}/csv", f"{scratch}/loaded", refresh=True)[1].collect())
    raw = {name: spark.read.parquet(f"{scratch}/raw/{name}") for name in raw_tables(spark, sf_dir)}

    m = models(raw, as_of=registry.AS_OF)
    for name in MODELS:
        timed(name, lambda: run_noop(m[name]))

    def suite():
        run_suite(staged_models(spark, raw, registry.AS_OF), model_suite().checks).collect()
    timed("check_suite", suite)

    def full_build():
        res = build(spark, raw, f"{scratch}/out", as_of=registry.AS_OF)
        res.checks.collect()  # 81 summary rows
    timed("full_build_with_checks", full_build)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf.group(1)) if sf else None,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
