"""DuckDB oracle for the operator-level queries (test-data tables directly)."""

from __future__ import annotations

from duck_oracle import KEY_NULL, _ddiff, _exact, _iavg, _key, _msum, _round

ORDER_TEXT = """CASE WHEN o_orderkey % 10 = 0 THEN 'bad ' || CAST(o_orderkey AS VARCHAR)
  WHEN o_orderkey % 10 = 3 THEN strftime(o_orderdate, '%Y-%m-%d')
  ELSE strftime(o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)), '%Y-%m-%d %H:%M:%S') END"""

ANSWERED = "(ts + to_minutes(CAST(user_id * 17 AS BIGINT)))"

QUARTER = ("(CAST(CAST(l_quantity AS BIGINT) // 4 AS VARCHAR) || '.' || "
           "CAST((CAST(l_quantity AS BIGINT) % 4) * 25 AS VARCHAR))")

EPOCH_TEXT = """CASE event_id % 6
  WHEN 0 THEN CAST(event_id * 86413 + 1000000000 AS VARCHAR)
  WHEN 1 THEN CAST((event_id * 86413 + 1000000000) * 1000 + event_id % 1000 AS VARCHAR)
  WHEN 2 THEN CAST((event_id * 86413 + 1000000000) * 1000000 + event_id % 1000000 AS VARCHAR)
  WHEN 3 THEN CAST(CAST(event_id * 86413 + 1000000000 AS HUGEINT) * 1000000000 + event_id * 7 AS VARCHAR)
  WHEN 4 THEN CAST(-(event_id * 86413) AS VARCHAR)
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""

EPOCH_PARSE = """CASE WHEN regexp_full_match(trim(txt), '[+-]?[0-9]{1,30}') THEN make_timestamp(CAST(
    CASE WHEN n < 0 THEN n * 1000000 WHEN n < 31536000000 THEN n * 1000000 WHEN n < 31536000000000 THEN n * 1000
         WHEN n < 31536000000000000 THEN n ELSE n // 1000 END AS BIGINT))
  ELSE try_cast(txt AS TIMESTAMP) END"""

DAILY = f"(SELECT CAST(o_orderdate AS DATE) AS day, {_msum('o_totalprice')} AS revenue FROM orders GROUP BY 1)"

SQL = {
    # plain DOUBLE sums, rounded at the end (averages a hair below, so none is a tie)
    "subcent_sums": """
SELECT day, round(total, 6) AS total, round(mean - 3e-8, 6) AS mean, round(avg(total) OVER w - 3e-8, 6) AS total_7_rows,
  round(sum(total) OVER (PARTITION BY date_trunc('month', day) ORDER BY day ASC NULLS LAST), 6) AS total_mtd,
  round(sum(total) OVER (ORDER BY day ASC NULLS LAST), 6) AS total_cumulative
FROM (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_extendedprice * l_tax / 10) AS total,
        avg(l_extendedprice * l_tax / 10) AS mean FROM lineitem GROUP BY 1)
WINDOW w AS (ORDER BY day ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "filter_status": "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, "
                     "coalesce(o_orderstatus = 'F', false) AS is_final FROM orders) WHERE is_final",
    "clean_text": """
SELECT c_custkey, lower(trim('  ' || c_mktsegment || ' ')) AS seg_lower,
  upper(trim('  ' || c_mktsegment || ' ')) AS seg_upper,
  nullif(trim(CASE WHEN c_custkey % 7 = 0 THEN '   ' ELSE '  ' || c_mktsegment || ' ' END), '') AS seg_or_null
FROM customer""",
    "safe_timestamp": f"SELECT o_orderkey, {ORDER_TEXT} AS txt, try_cast({ORDER_TEXT} AS TIMESTAMP) AS parsed_at "
                      "FROM orders",
    "epoch_timestamp": f"""
SELECT event_id, txt, {EPOCH_PARSE} AS parsed_at
FROM (SELECT event_id, txt, TRY_CAST(trim(txt) AS HUGEINT) AS n
      FROM (SELECT event_id, {EPOCH_TEXT} AS txt FROM events))""",
    "strict_casts": f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_linenumber AS VARCHAR) AS DOUBLE) AS line_d,
  CAST(round(CAST({QUARTER} AS DECIMAL(38,10)), 0) AS INTEGER) AS quarter_i,
  CAST({QUARTER} AS DOUBLE) AS quarter_d
FROM lineitem""",
    "day_diff": f"SELECT event_id, {_ddiff('ts', ANSWERED)} AS days FROM events",
    "hour_diff": f"SELECT event_id, CAST(date_diff('hour', ts, {ANSWERED}) AS BIGINT) AS hours FROM events",
    "date_parts": """
SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts_day,
  CAST(date_trunc('month', ts) AS TIMESTAMP) AS ts_month, CAST(date_trunc('year', ts) AS TIMESTAMP) AS ts_year,
  CAST(ts AS DATE) AS ts_date
FROM events""",
    "months_back": """
SELECT o_orderkey, d, CAST(d - INTERVAL 6 MONTH AS DATE) AS d_minus_6m
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 31 AS INTEGER) AS DATE) AS d FROM orders)""",
    "case_tiers": """
SELECT c_custkey, CASE WHEN bal >= 5000 THEN 'high' WHEN bal >= 1000 THEN 'mid' WHEN bal >= 0 THEN 'low'
  ELSE 'negative_or_null' END AS tier
FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS bal FROM customer)""",
    "round_ln_least": f"""
SELECT p_partkey, {_round('p_retailprice / 7', 2)} AS price_7th,
  {_round('least(ln(CAST(p_size AS DOUBLE) * 40 + 1) / ln(CAST(1000 AS DOUBLE)) * 100, CAST(100 AS DOUBLE)) * CAST(0.20 AS DOUBLE)', 2)}
    AS volume_score
FROM part""",
    "surrogate_key": f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                     f"{_key('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} AS line_key FROM lineitem",
    "left_join_default": """
SELECT s.s_suppkey, coalesce(n.n_name, 'unknown') AS nation_name
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey AND n.n_nationkey % 3 <> 0""",
    "inner_join_rollup": f"""
SELECT c.c_custkey, c.c_mktsegment, count(o.o_orderkey) AS total_orders, {_msum('o.o_totalprice')} AS lifetime_value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey AND o.o_custkey % 10 <> 0
GROUP BY c.c_custkey, c.c_mktsegment""",
    "left_join_rollups": f"""
SELECT o.o_orderkey, coalesce(l.line_count, 0) AS line_count, coalesce(l.gross, CAST(0 AS DOUBLE)) AS gross,
  coalesce(l.distinct_suppliers, 0) AS distinct_suppliers, r.last_return_ship
FROM orders o
LEFT JOIN (SELECT l_orderkey, count(*) AS line_count, {_msum('l_extendedprice')} AS gross,
             count(DISTINCT l_suppkey) AS distinct_suppliers FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_return_ship FROM lineitem WHERE l_returnflag = 'R'
           GROUP BY l_orderkey) r ON o.o_orderkey = r.l_orderkey""",
    "distinct_counts": """
SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(*) AS lines
FROM lineitem GROUP BY l_suppkey""",
    "arg_max": """
SELECT user_id, arg_max_null(event_type, CASE WHEN ts IS NOT NULL THEN {'t': ts, 'e': event_id} END) AS last_type
FROM events GROUP BY user_id""",
    "text_order_arg_max": """
SELECT user_id,
  arg_max_null(event_type, {'s': CAST(event_id AS VARCHAR), 't': event_type}) AS by_text,
  arg_max_null(event_type, {'s': CAST(CAST(event_id AS VARCHAR) AS DECIMAL(38,10)), 't': event_type}) AS by_number
FROM events GROUP BY user_id""",
    "mode_per_key": """
SELECT k.user_id, m.event_type AS mode_type
FROM (SELECT DISTINCT user_id FROM events) k
LEFT JOIN (SELECT user_id, event_type FROM (
    SELECT user_id, event_type,
      row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type ASC) AS rn
    FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type) WHERE rn = 1) m
  ON k.user_id IS NOT DISTINCT FROM m.user_id""",
    "conditional_counts": """
SELECT CAST(ts AS DATE) AS day, count(*) AS events,
  count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'view') AS views,
  count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM events GROUP BY 1""",
    "ratio_pct": f"""
SELECT l_suppkey, {_round('CAST(returned_lines AS DOUBLE) / nullif(orders, 0) * 100', 2)} AS return_rate_pct
FROM (SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines,
        count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_suppkey)""",
    "minmax_tenure": f"""
SELECT o_custkey, first_order, last_order, avg_key_mod, {_ddiff('first_order', 'last_order')} AS tenure_days
FROM (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
        {_iavg('(o_orderkey % 100)')} AS avg_key_mod FROM orders GROUP BY o_custkey)""",
    "segment_buckets": """
SELECT l_orderkey, CASE WHEN lines = 1 THEN 'one' WHEN lines BETWEEN 2 AND 3 THEN 'few' ELSE 'many' END AS bucket
FROM (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY l_orderkey)""",
    "latest_per_key": """
SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) AS rn
  FROM (SELECT event_id, user_id, event_type, CASE WHEN event_id % 13 <> 0 THEN ts END AS ts FROM events))
WHERE rn = 1""",
    "rolling_7_rows": f"""
SELECT day, revenue,
  {_round(_exact('sum(CAST(CAST(revenue AS VARCHAR) AS DECIMAL(38,10))) OVER w') + ' / count(revenue) OVER w', 2)} AS revenue_7_rows
FROM {DAILY} WINDOW w AS (ORDER BY day ASC NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "text_timestamps": "SELECT event_id, date_trunc('second', ts) AS parsed_at FROM events",
    "rolling_7_lines": f"""
SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
  {_round(_exact('sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,10))) OVER w') + ' / count(l_extendedprice) OVER w', 2)} AS price_7_rows
FROM lineitem WINDOW w AS (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "running_total_lines": f"""
SELECT l_shipdate, l_orderkey, l_linenumber, l_extendedprice,
  {_exact('sum(CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(38,10))) OVER (ORDER BY l_shipdate)')} AS price_cumulative
FROM lineitem""",
    "month_to_date": f"""
SELECT day, {_exact("""sum(CAST(CAST(revenue AS VARCHAR) AS DECIMAL(38,10))) OVER (PARTITION BY date_trunc('month', day)
  ORDER BY day ASC NULLS LAST)""")} AS revenue_mtd
FROM {DAILY}""",
    "running_total": f"""
SELECT day, {_exact('sum(CAST(CAST(revenue AS VARCHAR) AS DECIMAL(38,10))) OVER (ORDER BY day ASC NULLS LAST)')}
  AS revenue_cumulative
FROM {DAILY} ORDER BY day""",
}

assert KEY_NULL
