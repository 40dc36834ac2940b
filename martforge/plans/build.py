"""Full build: raw tables -> staging views -> M9 staged once -> marts written
-> data checks over what was written.

``orders_enriched`` (M9) has four consumers (M10-M13), so it is written once
(without the review text, which no consumer reads) and read back, as are the
zip centroids and the two roll-ups: that cuts the lineage (a lost executor
re-reads a file instead of recomputing joins) and every consumer reads a
pruned columnar copy.  Only what the selected models need is staged
(``NEEDS``), under a key of its inputs and arguments: a ``Staged`` folder can
be kept from one run to the next, which then rebuilds what changed.
The marts are written in full and made current together; ``fct_orders`` is
partitioned by purchase month.  The check suite then runs over the stored marts and the lazy staging
views; its summary is the only thing brought to the driver (81 rows).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import time
import uuid
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.operators.checks import run_suite
from martforge.plans import marts, rollups, staging
from martforge.plans.rules import model_suite
from martforge.session import checkpoint_dir, shuffles_released
from martforge.sources.sinks import as_view, delete, layer
from martforge.sources.snapshots import Publication, TableSet

MARTS = ("fct_orders", "fct_revenue_daily", "dim_customers", "dim_sellers")


def mart_layout(name: str) -> dict:
    """How each mart is written (``Publication.write`` options)."""
    if name == "fct_orders":
        return {"partition_by": ["purchase_month_key"]}
    if name == "fct_revenue_daily":  # one small file, in the model's order (NULL day last)
        return {"files": 1, "sort_within": [F.col("revenue_date").asc_nulls_last()]}
    return {}


@dataclass
class BuildResult:
    tables: dict[str, DataFrame]
    checks: DataFrame | None
    version: int  # commit of the marts layer


# what each staged intermediate is made from: raw tables, and other intermediates
MADE_FROM = {
    "orders_enriched": ("orders", "order_items", "order_payments", "order_reviews"),
    "stg_geolocation": ("geolocation",),
    "customer_rollup": ("orders_enriched", "customers"),
    "seller_rollup": ("orders_enriched", "order_items", "sellers"),
}

# the staged intermediates behind each model that is not a staging view
NEEDS = {
    "stg_geolocation": ("stg_geolocation",),
    "orders_enriched": ("orders_enriched",),
    "customer_rollup": ("orders_enriched", "customer_rollup"),
    "seller_rollup": ("orders_enriched", "seller_rollup"),
    "fct_orders": ("orders_enriched",),
    "fct_revenue_daily": ("orders_enriched",),
    "dim_customers": ("orders_enriched", "customer_rollup", "stg_geolocation"),
    "dim_sellers": ("orders_enriched", "seller_rollup", "stg_geolocation"),
}


STAGE_FORMAT = 1  # raise it when a staged model's rows or columns change


def frame_key(df: DataFrame) -> str | None:
    """A key of a raw table's contents: its files' names, sizes and times, and its plan.

    The plan's hash holds within a session; another one may compute the table
    anew, but never takes it for a different plan's.  None if there are no files
    (rows made in memory): such an input is never taken for an earlier one."""
    spark = df.sparkSession
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    seen = [df.schema.json(), df.semanticHash()]
    files = df.inputFiles()
    for name in sorted(files):
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI.create(name))
        status = p.getFileSystem(conf).getFileStatus(p)
        seen.append(f"{name}\t{status.getLen()}\t{status.getModificationTime()}")
    return _digest(seen) if files else None


def _digest(parts: Sequence[object]) -> str:
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()[:32]


class Staged:
    """Intermediates written once to a folder on shared storage, under a key of what they are made from.

    Without ``path`` a fresh folder under ``spark.checkpoint.dir`` is used.  An
    intermediate that is already there (of an earlier or a concurrent run) with
    the same key is read, not computed again; one with another key is left
    alone, so runs over other inputs or with other arguments share the folder
    without reading or deleting each other's rows.  ``sweep`` deletes what was
    not used for a while, ``delete`` the whole folder."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or f"{checkpoint_dir(spark).rstrip('/')}/martforge-stage-{uuid.uuid4().hex}"
        self.used: dict[str, str] = {}
        self.made: list[str] = []

    def get(self, name: str, make, key: str | None = None) -> DataFrame:
        """The intermediate of this ``key``; None: made anew, for this run only."""
        key = key or f"once-{uuid.uuid4().hex}"
        self.used[name] = key
        stored = TableSet(self.spark, f"{self.path}/{name}/{key}")
        if stored.current() is None:
            with stored.begin() as new:
                new.write(make(), "")
                new.commit()
            self.made.append(name)
        return stored.read("")

    def sweep(self, hours: float = 24.0) -> None:
        """Delete intermediates that this run does not use and that are older than ``hours``."""
        files = TableSet(self.spark, self.path).files
        now = time.time() * 1000
        for name, is_dir, _ in files.names(self.path):
            for key, _, changed in files.names(f"{self.path}/{name}") if is_dir else ():
                if self.used.get(name) != key and now - changed > hours * 3600_000:
                    files.delete(f"{self.path}/{name}/{key}")

    def delete(self) -> None:
        delete(self.spark, self.path)


def concurrently(*jobs):
    """Run independent Spark actions as concurrent jobs (one driver thread
    each) so their stages share the executors; returns their results."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]


def staged_models(spark: SparkSession, raw: dict[str, DataFrame], as_of: dt.date | str | None = None,
                  numeric_payment_order: bool = False, wanted: Collection[str] | None = None,
                  staged: Staged | None = None, keys: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The ``wanted`` models (default: all) and every staging view.

    The shared intermediates that the wanted models need are written once and
    read back: ``orders_enriched`` (four consumers), the zip centroids (two
    dimensions), the person and seller roll-ups (a dimension and their checks
    each).  Staging views and marts stay lazy here.

    ``keys`` names the contents of the raw tables (``csv_ingest.loaded_keys``);
    without it they are keyed by their files (``frame_key``).  A staged table's
    key is that of its inputs and of the arguments it depends on."""
    staged = staged or Staged(spark)
    known: dict[str, str | None] = dict(keys or {})

    def key_of(name: str) -> str | None:
        if name not in known:
            parts = [key_of(n) for n in MADE_FROM[name]] if name in MADE_FROM else None
            if parts is None:
                known[name] = frame_key(raw[name])
            else:
                args = [numeric_payment_order] if name == "orders_enriched" else []
                known[name] = None if None in parts else _digest([STAGE_FORMAT, name, *parts, *args])
        return known[name]

    wanted = set(NEEDS if wanted is None else wanted)
    needed = {n for model in wanted for n in NEEDS.get(model, ())}
    s = staging.staging(raw)
    first = {
        "orders_enriched": lambda: rollups.orders_enriched(
            s["stg_orders"], s["stg_order_items"], s["stg_order_payments"], s["stg_order_reviews"],
            numeric_payment_order, review_text=False, hot=rollups.hot_keys(s["stg_order_items"], "order_id")),
        "stg_geolocation": lambda: s["stg_geolocation"],
    }
    out = dict(s)

    def stage(makers):
        names = [n for n in makers if n in needed]
        if names:
            cut = [key_of(n) for n in names]
            out.update(zip(names, concurrently(*[lambda n=n, k=k: staged.get(n, makers[n], k) for n, k in zip(names, cut)])))

    stage(first)
    m9, geo = out.get("orders_enriched"), out["stg_geolocation"]
    stage({
        "customer_rollup": lambda: rollups.customer_rollup(m9, s["stg_customers"]),
        "seller_rollup": lambda: rollups.seller_rollup(
            s["stg_order_items"], m9, s["stg_sellers"], rollups.hot_orders(m9), rollups.hot_keys(s["stg_order_items"], "seller_id")),
    })
    final = {
        "fct_orders": lambda: marts.fct_orders(m9, s["stg_customers"]),
        "fct_revenue_daily": lambda: marts.fct_revenue_daily(m9),
        "dim_customers": lambda: marts.dim_customers(out["customer_rollup"], geo, as_of),
        "dim_sellers": lambda: marts.dim_sellers(out["seller_rollup"], geo),
    }
    out.update({name: make() for name, make in final.items() if name in wanted})
    return out


def build(spark: SparkSession, raw: dict[str, DataFrame], root: str, env: str = "dev",
          as_of: dt.date | str | None = None, run_checks: bool = True, register_views: bool = False,
          numeric_payment_order: bool = False, marts: tuple[str, ...] = MARTS,
          staged: Staged | None = None, keys: Mapping[str, str] | None = None) -> BuildResult:
    """Write the four marts (or the selected ``marts``) under
    ``<root>/<env>_marts``, make them current together, and return them (read
    back from storage) with the check summary over the built tables.

    Readers see the marts of the build before until the commit, which is one
    small file (``sources.snapshots``); a build that fails or is killed leaves
    them.  Marts that were not selected stay as they are.

    ``register_views`` also exposes every model as a temp view (SINK1).  The
    staged intermediates are deleted at the end unless the caller passes a
    ``staged`` folder to keep, or asks for views or checks that read them."""
    unknown = set(marts) - set(MARTS)
    if unknown:
        raise ValueError(f"unknown marts {sorted(unknown)}; choose from {list(MARTS)}")
    keep = staged is not None or register_views or run_checks
    staged = staged or Staged(spark)
    wanted = NEEDS if register_views or run_checks else marts
    stored_in = layer(spark, root, env, "marts")
    with shuffles_released(spark):
        tables = staged_models(spark, raw, as_of, numeric_payment_order, wanted, staged, keys)

        def write_mart(new: Publication, name: str):
            def job():
                df = tables[name]
                if name == "fct_orders":
                    df = df.withColumn("purchase_month_key", F.date_format("purchase_month", "yyyy-MM"))
                new.write(df, name, **mart_layout(name))
            return job

        with stored_in.begin() as new:
            concurrently(*[write_mart(new, n) for n in marts])
            done = new.commit(notes={"as_of": str(as_of), "numeric_payment_order": numeric_payment_order, "built": list(marts)})
    stored_in.expire()
    stored = {name: read_mart(spark, root, env, name, version=done.version) for name in marts}
    tables.update(stored)
    if register_views:
        for name, df in tables.items():
            as_view(df, name)
    checks = run_suite(tables, model_suite().checks) if run_checks else None
    if not keep:
        staged.delete()
    return BuildResult(stored, checks, done.version)


def read_mart(spark: SparkSession, root: str, env: str, name: str, months: Collection[str] | None = None,
              version: int | None = None) -> DataFrame:
    """A stored mart, of the newest build or of the commit ``version``.
    ``months`` ('yyyy-MM') reads only those partitions of ``fct_orders``."""
    t = layer(spark, root, env, "marts").read(name, version)
    if "purchase_month_key" not in t.columns:
        return t
    if months is not None:
        t = t.filter(F.col("purchase_month_key").isin(list(months)))
    return t.drop("purchase_month_key")


def read_marts(spark: SparkSession, root: str, env: str) -> dict[str, DataFrame]:
    """All stored marts of one and the same commit, whatever is published meanwhile."""
    now = layer(spark, root, env, "marts").current()
    return {name: read_mart(spark, root, env, name, version=now.version) for name in now.tables} if now else {}
