"""Operator-level queries: each applies one generic operator or helper to a
is in ``duck_oracle/operators.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions import (
    avg_exact, avg_money, blank_to_null, clean_lower, clean_upper, day_diff, hour_diff, months_back, round_half_up,
    safe_ratio_pct, sum_money, surrogate_key, to_double, to_int, to_timestamp, trunc_ts,
)
from martforge.operators.aggregates import arg_max, conditional_counts, mode_per_key
from martforge.operators.latest import latest_per_key
from martforge.operators.windows import period_to_date_sum, rolling_rows_avg, running_total, with_rolling_rows_avg, with_running_total


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def filter_status(spark, sf_dir):
    """FL1/PD3: filter on a derived boolean flag."""
    o = _t(spark, sf_dir, "orders")
    flagged = o.select("o_orderkey", "o_totalprice",
                       F.coalesce(F.col("o_orderstatus") == "F", F.lit(False)).alias("is_final"))
    return flagged.filter(F.col("is_final")).select("o_orderkey", "o_totalprice")


def clean_text(spark, sf_dir):
    """SC1-SC3 on padded segment names."""
    c = _t(spark, sf_dir, "customer")
    padded = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))
    blanked = F.when(F.col("c_custkey") % 7 == 0, F.lit("   ")).otherwise(padded)
    return c.select("c_custkey", clean_lower(padded).alias("seg_lower"), clean_upper(padded).alias("seg_upper"),
                    blank_to_null(blanked).alias("seg_or_null"))


def _order_text(k):
    return (F.when(k % 10 == 0, F.concat(F.lit("bad "), k.cast("string")))
            .when(k % 10 == 3, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .otherwise(F.date_format(F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate")),
                                     "yyyy-MM-dd HH:mm:ss")))


def safe_timestamp(spark, sf_dir):
    """SC7: text to timestamp, NULL when it does not parse (every 10th);
    date-only text is midnight."""
    o = _t(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    txt = _order_text(k)
    return o.select("o_orderkey", txt.alias("txt"), to_timestamp(txt).alias("parsed_at"))


def epoch_timestamp(spark, sf_dir):
    """SC7 on integer text: epoch seconds / ms / us / ns by magnitude,
    negative always seconds; other text parses as a date-time."""
    e = _t(spark, sf_dir, "events")
    eid = F.col("event_id")
    base = eid * 86413 + 1000000000
    k = eid % 6
    txt = (F.when(k == 0, base.cast("string"))
           .when(k == 1, (base * 1000 + eid % 1000).cast("string"))
           .when(k == 2, (base * 1000000 + eid % 1000000).cast("string"))
           .when(k == 3, (base.cast("decimal(38,0)") * 1000000000 + eid * 7).cast("string"))
           .when(k == 4, (-(eid * 86413)).cast("string"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return e.select("event_id", txt.alias("txt"), to_timestamp(txt).alias("parsed_at"))


def strict_casts(spark, sf_dir):
    """SC5/SC6: text to double and to int (fractions round half away from 0)."""
    li = _t(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("long")
    quarter = F.concat((q / 4).cast("long").cast("string"), F.lit("."), ((q % 4) * 25).cast("string"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     to_double(F.col("l_linenumber").cast("string")).alias("line_d"),
                     to_int(quarter).alias("quarter_i"),
                     to_double(quarter).alias("quarter_d"))


def _answered(e):
    return F.timestamp_add("MINUTE", F.col("user_id") * 17, F.col("ts"))


def day_diff_q(spark, sf_dir):
    """SC9: calendar-day boundaries between ts and ts + user_id*17 minutes."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", day_diff("ts", _answered(e)).alias("days"))


def hour_diff_q(spark, sf_dir):
    """SC10: hour boundaries between ts and ts + user_id*17 minutes."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", hour_diff("ts", _answered(e)).alias("hours"))


def date_parts(spark, sf_dir):
    """SC8/SC11: day, month, year truncation and the date."""
    e = _t(spark, sf_dir, "events")
    return e.select("event_id", trunc_ts("DAY", "ts").alias("ts_day"), trunc_ts("MONTH", "ts").alias("ts_month"),
                    trunc_ts("YEAR", "ts").alias("ts_year"), F.to_date("ts").alias("ts_date"))


def months_back_q(spark, sf_dir):
    """SC12: six months back from the order date (month end clamps)."""
    o = _t(spark, sf_dir, "orders")
    d = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 31).cast("int"))
    return o.select("o_orderkey", d.alias("d"), months_back(d, 6).alias("d_minus_6m"))


def case_tiers(spark, sf_dir):
    """SC15: searched CASE tiers; a NULL condition falls through."""
    c = _t(spark, sf_dir, "customer")
    bal = F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal"))
    tier = F.when(bal >= 5000, "high").when(bal >= 1000, "mid").when(bal >= 0, "low").otherwise("negative_or_null")
    return c.select("c_custkey", tier.alias("tier"))


def round_ln_least(spark, sf_dir):
    """SC16-SC19: rounding, ln-based capped volume score."""
    p = _t(spark, sf_dir, "part")
    vol = F.least(F.log(F.col("p_size").cast("double") * 40 + 1) / F.log(F.lit(1000.0)) * 100, F.lit(100.0))
    return p.select("p_partkey",
                    round_half_up(F.col("p_retailprice") / 7, 2).alias("price_7th"),
                    round_half_up(vol * 0.20, 2).alias("volume_score"))


def surrogate_key_q(spark, sf_dir):
    """SC20: md5 key over all key columns of a line."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     surrogate_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_key"))


def left_join_default(spark, sf_dir):
    """JN1 + SC14: suppliers left-joined to nations of which a third are re-keyed to match nothing, default name."""
    s = _t(spark, sf_dir, "supplier")
    n = _t(spark, sf_dir, "nation")
    key = F.when(F.col("n_nationkey") % 3 == 0, -1 - F.col("n_nationkey")).otherwise(F.col("n_nationkey"))
    n = n.select(key.alias("key"), "n_name")
    j = s.join(n, s["s_nationkey"] == n["key"], "left")
    return j.select("s_suppkey", F.coalesce(F.col("n_name"), F.lit("unknown")).alias("nation_name"))


def inner_join_rollup(spark, sf_dir):
    """JN5 + roll-up: orders joined to customers, one row per customer."""
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer")
    key = F.when(F.col("o_custkey") % 10 == 0, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))  # a tenth matches nothing
    j = o.withColumn("key", key).join(c, F.col("key") == c["c_custkey"], "inner")
    return j.groupBy("c_custkey", "c_mktsegment").agg(
        F.count("o_orderkey").alias("total_orders"),
        sum_money("o_totalprice").alias("lifetime_value"),
    )


def left_join_rollups(spark, sf_dir):
    """JN2-JN4: orders left-joined to two pre-aggregated children; orders
    without lines are zero-filled."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    li = _t(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("line_count"),
        sum_money("l_extendedprice").alias("gross"),
        F.countDistinct("l_suppkey").alias("distinct_suppliers"),
    )
    returned = li.filter(F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_return_ship"))
    j = (o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left").drop("l_orderkey")
         .join(returned, o["o_orderkey"] == returned["l_orderkey"], "left"))
    return j.select(
        "o_orderkey",
        F.coalesce("line_count", F.lit(0).cast("long")).alias("line_count"),
        F.coalesce("gross", F.lit(0.0)).alias("gross"),
        F.coalesce("distinct_suppliers", F.lit(0).cast("long")).alias("distinct_suppliers"),
        "last_return_ship",
    )


def distinct_counts(spark, sf_dir):
    """AG2/AG4: two distinct counts and a row count per supplier."""
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy("l_suppkey").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct("l_partkey").alias("parts"),
        F.count(F.lit(1)).alias("lines"),
    )


def arg_max_q(spark, sf_dir):
    """AG8: event type at each user's latest event (ties by event id)."""
    e = _t(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(arg_max("event_type", ["ts", "event_id"]).alias("last_type"))


def text_order_arg_max(spark, sf_dir):
    """Q1: arg-max on a text ordering ('9' > '10') against the numeric one."""
    e = _t(spark, sf_dir, "events")
    seq = F.col("event_id").cast("string")
    return e.groupBy("user_id").agg(
        arg_max("event_type", [seq, "event_type"]).alias("by_text"),
        arg_max("event_type", [seq, "event_type"], numeric_order=True).alias("by_number"),
    )


def mode_per_key_q(spark, sf_dir):
    """AG9: most common event type per user (smallest on ties)."""
    e = _t(spark, sf_dir, "events")
    return mode_per_key(e, "user_id", "event_type", "mode_type")


def conditional_counts_q(spark, sf_dir):
    """AG10/AG14: fixed-column pivot of event types per day."""
    e = _t(spark, sf_dir, "events")
    t = F.col("event_type")
    return e.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        *conditional_counts({"clicks": t == "click", "views": t == "view", "purchases": t == "purchase"}),
    )


def ratio_pct(spark, sf_dir):
    """AG11/AG12: returned lines per distinct order, in percent, per supplier."""
    li = _t(spark, sf_dir, "lineitem")
    g = li.groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).cast("long").alias("returned_lines"),
        F.countDistinct("l_orderkey").alias("orders"),
    )
    return g.select("l_suppkey", safe_ratio_pct(F.col("returned_lines"), F.col("orders")).alias("return_rate_pct"))


def minmax_tenure(spark, sf_dir):
    """AG7/AG13: first and last order and the tenure in days per customer."""
    o = _t(spark, sf_dir, "orders")
    g = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"),
                                   F.max("o_orderdate").alias("last_order"),
                                   avg_exact(F.col("o_orderkey") % 100).alias("avg_key_mod"))
    return g.withColumn("tenure_days", day_diff("first_order", "last_order"))


def segment_buckets(spark, sf_dir):
    """PD2: bucket orders by line count (1 / 2-3 / more)."""
    li = _t(spark, sf_dir, "lineitem")
    n = F.col("lines")
    g = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    return g.select("l_orderkey", F.when(n == 1, "one").when(n.between(2, 3), "few").otherwise("many")
                    .alias("bucket"))


def latest_per_key_q(spark, sf_dir):
    """WN1/FL2/ST2: each user's latest event; a NULL time counts as latest."""
    e = _t(spark, sf_dir, "events")
    e = e.select("event_id", "user_id", "event_type",
                 F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("ts"))
    return latest_per_key(e, ["user_id"], [F.col("ts").desc_nulls_first(), F.col("event_id").desc()])


def _daily_orders(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(sum_money("o_totalprice").alias("revenue"))


def rolling_7_rows(spark, sf_dir):
    """WN2: 7-row rolling average of daily order revenue."""
    d = _daily_orders(spark, sf_dir)
    return d.select("day", "revenue", rolling_rows_avg("revenue", "day", 7).alias("revenue_7_rows"))


def month_to_date(spark, sf_dir):
    """WN3: month-to-date daily order revenue."""
    d = _daily_orders(spark, sf_dir)
    return d.select("day", period_to_date_sum("revenue", "day", "month").alias("revenue_mtd"))


def running_total_q(spark, sf_dir):
    """WN4/ST1: running total of daily order revenue, sorted by day."""
    d = _daily_orders(spark, sf_dir)
    return d.select("day", running_total("revenue", "day").alias("revenue_cumulative")).orderBy("day")


def text_timestamps(spark, sf_dir):
    """SC7: event times written in six documented forms, and read back."""
    ts = F.col("ts")
    form = lambda f: F.date_format(ts, f)
    written = [form("yyyy-MM-dd HH:mm:ss"), F.concat(form("EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), form("yyyy")), form("MM/dd/yyyy h:mm:ss a"),
               form("M/d/yyyy H:mm:ss"), F.concat(form("EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0200")), F.concat(form("EEE, dd MMM yyyy hh:mm:ss a"), F.lit(" GMT"))]
    e = _t(spark, sf_dir, "events").select("event_id", F.element_at(F.array(*written), (F.col("event_id") % 6 + 1).cast("int")).alias("txt"))
    return e.select("event_id", to_timestamp("txt").alias("parsed_at"))


def rolling_7_lines(spark, sf_dir):
    """WN2 at line grain: 7-row rolling average of the price over all lines in ship order."""
    li = _t(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return with_rolling_rows_avg(li, "l_extendedprice", ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"], 7, "price_7_rows", ranges=16)


def running_total_lines(spark, sf_dir):
    """WN4 at line grain: the price shipped up to and with each line's day."""
    li = _t(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return with_running_total(li, "l_extendedprice", "l_shipdate", "price_cumulative", ranges=16)


def subcent_sums(spark, sf_dir):
    """AG5/AG6/WN2-WN4 on amounts with fractions of a cent: tax of each line, by ship day."""
    li = _t(spark, sf_dir, "lineitem")
    tax = F.col("l_extendedprice") * F.col("l_tax") / 10
    days = li.groupBy(F.to_date("l_shipdate").alias("day")).agg(sum_money(tax).alias("total"), avg_money(tax).alias("mean"))
    six = lambda c: F.round(c, 6)
    return days.select(
        "day", six(F.col("total")).alias("total"), six(F.col("mean") - 3e-8).alias("mean"),
        six(rolling_rows_avg("total", "day", 7, digits=None) - 3e-8).alias("total_7_rows"),
        six(period_to_date_sum("total", "day")).alias("total_mtd"),
        six(running_total("total", "day")).alias("total_cumulative"))


QUERIES = {
    "subcent_sums": subcent_sums,
    "filter_status": filter_status,
    "clean_text": clean_text,
    "safe_timestamp": safe_timestamp,
    "epoch_timestamp": epoch_timestamp,
    "strict_casts": strict_casts,
    "day_diff": day_diff_q,
    "hour_diff": hour_diff_q,
    "date_parts": date_parts,
    "months_back": months_back_q,
    "case_tiers": case_tiers,
    "round_ln_least": round_ln_least,
    "surrogate_key": surrogate_key_q,
    "left_join_default": left_join_default,
    "inner_join_rollup": inner_join_rollup,
    "left_join_rollups": left_join_rollups,
    "distinct_counts": distinct_counts,
    "arg_max": arg_max_q,
    "text_order_arg_max": text_order_arg_max,
    "mode_per_key": mode_per_key_q,
    "conditional_counts": conditional_counts_q,
    "ratio_pct": ratio_pct,
    "minmax_tenure": minmax_tenure,
    "segment_buckets": segment_buckets,
    "latest_per_key": latest_per_key_q,
    "rolling_7_rows": rolling_7_rows,
    "text_timestamps": text_timestamps,
    "rolling_7_lines": rolling_7_lines,
    "running_total_lines": running_total_lines,
    "month_to_date": month_to_date,
    "running_total": running_total_q,
}
