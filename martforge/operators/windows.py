"""Trend windows over an ordered series (WN2-WN4).

``rolling_rows_avg`` and ``running_total`` are columns for an
already-aggregated series (one row per day): a window with no partition key
moves every row to one task.  ``with_rolling_rows_avg`` and
``with_running_total`` give the same values over a series of any size;
``period_to_date_sum`` partitions by period and scales.
Sums are exact decimals of ``scale_type``, returned as double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.numeric import EXACT, round_half_up
from martforge.functions.text import _c


def rolling_rows_avg(value, order_col: str, rows: int, digits: int | None = 2,
                     scale_type: str = EXACT) -> Column:
    """WN2 ``avg(x) over (order by o rows between rows-1 preceding and current
    row)``: a frame of rows, not of days — gaps in the series are not filled."""
    w = Window.orderBy(F.col(order_col).asc_nulls_last()).rowsBetween(-(rows - 1), Window.currentRow)
    v = _c(value)
    avg = F.sum(v.cast(scale_type)).over(w).cast("double") / F.count(v).over(w)
    return round_half_up(avg, digits) if digits is not None else avg


def period_to_date_sum(value, order_col: str, period: str = "month", scale_type: str = EXACT) -> Column:
    """WN3 ``sum(x) over (partition by date_trunc(period, o) order by o)``
    (default RANGE frame: ties on ``o`` share the sum)."""
    w = Window.partitionBy(F.trunc(F.to_date(F.col(order_col)), period)).orderBy(F.col(order_col).asc_nulls_last())
    return F.sum(_c(value).cast(scale_type)).over(w).cast("double")


def running_total(value, order_col: str, scale_type: str = EXACT) -> Column:
    """WN4 ``sum(x) over (order by o)``; NULL order values come last."""
    w = Window.orderBy(F.col(order_col).asc_nulls_last())
    return F.sum(_c(value).cast(scale_type)).over(w).cast("double")


# --- the same windows over a series of any size ------------------------------
#
# A window without a partition key moves every row to one task.  Here the
# series is cut into ranges of the order column; each range is windowed by
# itself, and what the ranges before it add is one small row a range.

#: rows of a range, on average, when the caller does not say how many ranges
RANGE_ROWS = 1_000_000
MOST_RANGES = 20_000
STEP = 128


def _ranged(df: DataFrame, order_col: str, ranges: int | None) -> tuple[DataFrame, str]:
    """The rows with ``__range``: 0, 1, .. rising with the order column, the last range for NULL.

    Borders are quantiles of the order column (numbers, dates or timestamps),
    at most ``MOST_RANGES`` of them on the driver.  Equal values share a range."""
    n = ranges or min(MOST_RANGES, df.count() // RANGE_ROWS + 1)
    borders = []
    if n > 1:
        shares = F.array(*[F.lit(k / n) for k in range(1, n)])
        borders = sorted(set(df.agg(F.percentile_approx(order_col, shares, F.lit(max(10_000, 20 * n)))).first()[0] or []))
    o = F.col(order_col)
    if not borders:
        return df.withColumn("__range", F.when(o.isNull(), 1).otherwise(0)), "__range"
    up_to = lambda some: F.size(F.filter(some, lambda b: b <= o))
    table = F.array(*[F.lit(b) for b in borders])
    if len(borders) <= STEP:
        at = up_to(table)
    else:  # which block of borders, then which border in it
        block = up_to(F.array(*[F.lit(b) for b in borders[STEP - 1 :: STEP]]))
        at = block * STEP + up_to(F.slice(table, block * STEP + 1, F.lit(STEP)))
    return df.withColumn("__range", F.when(o.isNull(), len(borders) + 1).otherwise(at)), "__range"


def _before(totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per range, the running sums of the ranges before it; one row a range, at most ``MOST_RANGES`` + 1 of them."""
    w = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("__range", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"__before_{c}") for c in columns])


def with_running_total(df: DataFrame, value, order_col: str, alias: str, ranges: int | None = None,
                       scale_type: str = EXACT) -> DataFrame:
    """WN4 at any grain: ``df`` with ``running_total(value, order_col)`` as ``alias``, the same values, no single task.

    Rows that tie on ``order_col`` share the sum and a range; NULL order values
    come last.  A NULL total (no value so far) stays NULL."""
    rows, _ = _ranged(df.withColumn("__v", _c(value).cast(scale_type)), order_col, ranges)
    totals = rows.groupBy("__range").agg(F.coalesce(F.sum("__v"), F.lit(0).cast(scale_type)).alias("__t"), F.count("__v").alias("__n"))
    joined = rows.join(F.broadcast(_before(totals, ["__t", "__n"])), "__range")
    w = Window.partitionBy("__range").orderBy(F.col(order_col).asc_nulls_last())
    here = F.sum("__v").over(w)
    total = F.when(here.isNotNull() | (F.col("__before___n") > 0), F.coalesce(here, F.lit(0).cast(scale_type)) + F.col("__before___t"))
    return joined.withColumn(alias, total.cast("double")).select(*df.columns, alias)


def with_rolling_rows_avg(df: DataFrame, value, order_cols: Sequence[str], rows: int, alias: str, digits: int | None = 2,
                          ranges: int | None = None, scale_type: str = EXACT) -> DataFrame:
    """WN2 at any grain: the average over the row and the ``rows - 1`` before it, in the order of ``order_cols``, as ``alias``.

    The first order column cuts the ranges; all of them together should order
    the rows totally, else ties fall in any order.  A range gets copies of the
    last rows before it (the halo), found by their place in the whole series."""
    first = order_cols[0]
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    base, _ = _ranged(df.withColumn("__v", _c(value).cast(scale_type)), first, ranges)
    counts = base.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    starts = _before(counts, ["__n"]).join(counts, "__range").withColumnRenamed("__before___n", "__start")
    here = Window.partitionBy("__range").orderBy(*order)
    placed = base.join(F.broadcast(starts), "__range").withColumn("__local", F.row_number().over(here))
    placed = placed.withColumn("__at", F.col("__start") + F.col("__local"))  # 1, 2, .. over the whole series
    # a range that starts after row s needs the rows s - rows + 2 .. s
    halo = (placed.filter(F.col("__local") > F.col("__n") - (rows - 1)).select("__at", "__v", F.col("__range").alias("__from"))
            .withColumn("__start", F.explode(F.sequence(F.col("__at"), F.col("__at") + (rows - 2)))) if rows > 1 else None)
    frame = Window.partitionBy("__range").orderBy("__at").rowsBetween(-(rows - 1), Window.currentRow)
    all_rows = placed.drop("__start", "__local", "__n").withColumn("__own", F.lit(True))
    if halo is not None:
        copies = halo.join(F.broadcast(starts.select("__range", "__start")), "__start").filter("__range > __from")
        all_rows = all_rows.unionByName(copies.select("__range", "__at", "__v", F.lit(False).alias("__own")), allowMissingColumns=True)
    avg = F.sum("__v").over(frame).cast("double") / F.nullif(F.count("__v").over(frame), F.lit(0))
    out = all_rows.withColumn(alias, round_half_up(avg, digits) if digits is not None else avg)
    return out.filter("__own").select(*df.columns, alias)
