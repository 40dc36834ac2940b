"""Scaling check input: the test-data tables replicated N times with shifted
keys (orders, line items, customers, events; dimension tables as they are),
written to a scratch folder.  Used only to time bench.py at a larger size.

usage: python tools/scaleup.py <src sf dir> <dst dir, e.g. /tmp/scaleup/sf1.0> [copies=10]
then:  BENCH_SF_DIR=<dst dir> python bench.py
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main(argv):
    src, dst = argv[1], argv[2]
    copies = int(argv[3]) if len(argv) > 3 else 10
    from martforge.session import local_session

    spark = local_session()
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    span = {t: read(t).agg(F.max(k)).first()[0] + 1
            for t, k in (("orders", "o_orderkey"), ("customer", "c_custkey"), ("events", "event_id"))}

    def replicate(df):
        return df.withColumn("__i", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
            "__i", F.col("__i").cast("long"))

    shift = lambda c, t: (F.col(c) + F.col("__i") * span[t]).alias(c)
    out = {
        "orders": replicate(read("orders")).withColumn("o_orderkey", shift("o_orderkey", "orders"))
        .withColumn("o_custkey", shift("o_custkey", "customer")).drop("__i"),
        "lineitem": replicate(read("lineitem")).withColumn("l_orderkey", shift("l_orderkey", "orders")).drop("__i"),
        "customer": replicate(read("customer")).withColumn("c_custkey", shift("c_custkey", "customer")).drop("__i"),
        "events": replicate(read("events")).withColumn("event_id", shift("event_id", "events")).drop("__i"),
    }
    for t in ("region", "nation", "supplier", "part"):
        out[t] = read(t)
    for t, df in out.items():
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
        print(t, spark.read.parquet(f"{dst}/{t}.parquet").count())


if __name__ == "__main__":
    main(sys.argv)
