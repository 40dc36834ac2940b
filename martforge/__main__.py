"""Command line: the three steps a user runs.

  python -m martforge load --input DIR --lake DIR     raw CSVs -> <lake>/raw (+ quarantine), load report
  python -m martforge run  --lake DIR [--env dev] [--as-of YYYY-MM-DD] [--select fct_orders,...]
                                                       raw -> <lake>/<env>_marts/<model>
  python -m martforge test --lake DIR [--env dev] [--as-of YYYY-MM-DD] [--select fct_orders,...]
                                                       the 81 checks (or those of the selected models) over
                                                       staging views and stored marts; exit 1 on a failure

On a cluster, submit with spark-submit; the session's own settings win (the
shared checkpoint folder must be set as ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from martforge.operators.checks import run_suite
from martforge.plans.build import MARTS, Staged, build, read_marts, staged_models
from martforge.plans.rules import model_suite
from martforge.session import checkpoint_dir, configure
from martforge.sources import csv_ingest
from martforge.sources.sinks import layer_path


def _raw(spark: SparkSession, lake: str):
    """The published raw tables and the keys of their contents."""
    folder = f"{lake.rstrip('/')}/raw"
    return csv_ingest.loaded(spark, folder), csv_ingest.loaded_keys(spark, folder)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="martforge")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("load")
    a.add_argument("--input", required=True)
    a.add_argument("--lake", required=True)
    for name in ("run", "test"):
        b = sub.add_parser(name)
        b.add_argument("--lake", required=True)
        b.add_argument("--env", default="dev")
        b.add_argument("--as-of", default=None)
        b.add_argument("--select", default=None,
                       help="comma-separated model names: marts to build (run) or models to check (test)")
        b.add_argument("--numeric-payment-order", action="store_true",
                       help="rank payment_sequential as a number, not as text, for the primary payment type")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"martforge-{args.cmd}").getOrCreate()
    configure(spark, scale="local" if spark.sparkContext.master.startswith("local") else "cluster")
    checkpoint_dir(spark)
    if args.cmd == "load":
        try:
            _, report = csv_ingest.load_raw(spark, args.input, f"{args.lake.rstrip('/')}/raw")
        except (csv_ingest.MissingInputError, csv_ingest.ContractError) as e:
            print(f"load stopped: {e}", file=sys.stderr)
            return 2
        rows = report.collect()  # nine rows
        for r in rows:
            print(f"{r.table_name:40s} loaded {r.rows_loaded:>12,d}  rejected {r.rows_rejected:>10,d}")
        print(f"total loaded {sum(r.rows_loaded for r in rows):,d}")
        for r in csv_ingest.left_out(spark, f"{args.lake.rstrip('/')}/raw").collect():  # files with other columns
            print(f"left out {r.table_name}: {r.file} (header: {r.header})")
        return 0
    selected = [m.strip() for m in args.select.split(",")] if getattr(args, "select", None) else None
    if args.cmd == "run":
        unknown = set(selected or ()) - set(MARTS)
        if unknown:
            print(f"unknown marts {sorted(unknown)}; choose from {list(MARTS)}", file=sys.stderr)
            return 2
        # kept for the checks of this build and for the next build over the same tables
        staged = Staged(spark, layer_path(args.lake, args.env, "staged", "run"))
        raw, keys = _raw(spark, args.lake)
        res = build(spark, raw, args.lake, env=args.env, as_of=args.as_of, run_checks=False,
                    numeric_payment_order=args.numeric_payment_order, marts=tuple(selected or MARTS), staged=staged, keys=keys)
        staged.sweep()
        for name in res.tables:
            print(f"built {layer_path(args.lake, args.env, 'marts', name)} (commit {res.version})")
        return 0
    checks = model_suite().checks
    if selected:
        unknown = set(selected) - {c.model for c in checks}
        if unknown:
            print(f"no checks on {sorted(unknown)}", file=sys.stderr)
            return 2
        checks = [c for c in checks if c.model in selected]
    models = {c.model for c in checks} | {c.to_model for c in checks if c.to_model}
    staged = Staged(spark, layer_path(args.lake, args.env, "staged", "run"))  # what the build read, if it is still there
    raw, keys = _raw(spark, args.lake)
    tables = staged_models(spark, raw, args.as_of, args.numeric_payment_order, models - set(MARTS), staged, keys)
    tables.update({name: df for name, df in read_marts(spark, args.lake, args.env).items() if name in models})
    summary = run_suite(tables, checks).collect()  # one row per check
    failed = [r for r in summary if not r.passed]
    for r in summary:
        print(f"{'PASS' if r.passed else 'FAIL'} {r.check_name} ({r.failures})")
    print(f"{len(summary) - len(failed)} passed, {len(failed)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
