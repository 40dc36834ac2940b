"""Queries over the ingest and sink path (IO1-IO7, SINK1-SINK4).

Each derives raw text tables from the test data, writes them as CSV files to
a fresh folder under the shared checkpoint folder, and reads them back
through the ingest — so the whole data volume passes through the CSV
dialect, NULL tokens, header contract and quarantine split, and the build
writes and re-reads the marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.plans.build import build
from martforge.session import checkpoint_dir
from martforge.sources import csv_ingest as ci
from martforge.sources.contracts import MULTILINE_TABLES, RAW_COLUMNS
from martforge.sources.sinks import delete
from martforge.sources.testdata import BUILDERS, pad, raw_tables

AS_OF = "2001-08-01"


def _scratch(spark: SparkSession, what: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/martforge-{what}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write a raw text table as header CSV that the ingest reads back
    unchanged (spaces kept, quotes doubled, NULL as an empty field)."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("compression", compression)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def _round_trip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    base = _scratch(spark, "csv")
    write_csv(BUILDERS[table](spark, sf_dir), f"{base}/{table}.csv")
    return ci.good_rows(ci.read_raw_csv(spark, table, f"{base}/{table}.csv"))


def csv_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO1-IO4: raw orders through CSV and back."""
    return _round_trip(spark, sf_dir, "orders")


def csv_ingest_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO2/IO3: the multi-line free-text table; empty text becomes NULL."""
    return _round_trip(spark, sf_dir, "order_reviews")


def write_dirty_reviews(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Review lines from the whole ``documents`` table: the full text as a quoted
    field (quotes doubled, commas and newlines in it), every NULL token, lines
    with too few and too many fields."""
    d = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    k = F.col("doc_id")
    quoted = F.concat(F.lit('"'), F.replace(F.col("text"), F.lit('"'), F.lit('""')), F.lit('"'))
    token = F.element_at(F.array(*[F.lit(t) for t in ("NULL", "null", "NA", "N/A", "")]), (k % 5 + 1).cast("int"))
    title = F.when(k % 3 == 0, F.concat(F.lit('"say ""'), k.cast("string"), F.lit('"", ok"'))).otherwise(token)
    start = F.concat_ws(",", pad("R", k), pad("O", k))
    whole = F.concat_ws(",", start, (k % 5 + 1).cast("string"), title, quoted, F.lit("2018-01-02 03:04:05"), F.lit(""))
    line = F.when(k % 50 == 3, start).when(k % 50 == 7, F.concat_ws(",", whole, F.lit("one"), F.lit("more"))).otherwise(whole)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of its file
    header = F.lit(",".join(RAW_COLUMNS["order_reviews"]) + "\n")
    d.select(F.when(first, F.concat(header, line)).otherwise(line)).write.text(path)


def csv_ingest_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO2, IO3, IO5: the good rows of a dirty delivery, with the counts of good and rejected lines."""
    path = f"{_scratch(spark, 'csv')}/order_reviews.csv"
    write_dirty_reviews(spark, sf_dir, path)
    rows = ci.read_raw_csv(spark, "order_reviews", path)
    bad = F.col(ci.BAD).isNotNull()
    n = rows.agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"), F.count("review_id")).first()
    return ci.good_rows(rows).withColumns({"n_good": F.lit(n["good"]).cast("long"), "n_rejected": F.lit(n["bad"]).cast("long")})


def load_report_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO5/IO6: the load report of a delivery whose reviews are dirty."""
    (_, report), base = _load_all(spark, sf_dir, dirty=True)
    delete(spark, base)
    return report


def input_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO7: which of the nine inputs a partial delivery (orders and customers) holds."""
    base = _scratch(spark, "csv")
    for name in ("orders", "customers"):
        write_csv(BUILDERS[name](spark, sf_dir), f"{base}/{name}.csv")
    present = ci.inputs_present(spark, {t: f"{base}/{t}.csv" for t in BUILDERS})
    return spark.createDataFrame(sorted(present.items()), "table_name string, present boolean")


def _load_all(spark: SparkSession, sf_dir: str, dirty: bool = False):
    """All nine tables through CSV.  The CSV files are the largest copy of the data: they are
    compressed (but for the table whose records are found in byte ranges), and deleted once loaded."""
    base = _scratch(spark, "load")
    for name, df in raw_tables(spark, sf_dir).items():
        if dirty and name == "order_reviews":
            write_dirty_reviews(spark, sf_dir, f"{base}/csv/{name}.csv")
        else:
            write_csv(df, f"{base}/csv/{name}.csv", "none" if name in MULTILINE_TABLES else "lz4")
    loaded = ci.load_raw(spark, f"{base}/csv", f"{base}/raw")
    delete(spark, f"{base}/csv")
    return loaded, base


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO5-IO7: rows loaded and rejected per table, from one pass per table."""
    (_, report), base = _load_all(spark, sf_dir)
    delete(spark, base)
    return report


def build_revenue_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SINK3/SINK4: full build from CSV; the daily mart read back from storage."""
    (tables, _), base = _load_all(spark, sf_dir)
    res = build(spark, tables, f"{base}/out", as_of=AS_OF, run_checks=False)
    for scratch in ("raw", "_commits"):  # the marts are stored under out; nothing reads the raw tables any more
        delete(spark, f"{base}/{scratch}")
    return res.tables["fct_revenue_daily"]


QUERIES = {
    "csv_ingest_orders": csv_ingest_orders,
    "csv_ingest_reviews": csv_ingest_reviews,
    "csv_ingest_dirty": csv_ingest_dirty,
    "load_report": load_report,
    "load_report_dirty": load_report_dirty,
    "input_presence": input_presence,
    "build_revenue_daily": build_revenue_daily,
}
