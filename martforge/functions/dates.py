"""Date arithmetic (SC8-SC13).  Differences count calendar boundaries crossed,
not elapsed whole units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.text import _c


def day_diff(start, end) -> Column:
    """SC9 ``datediff('day', start, end)``: day boundaries between the two
    (23:59 -> 00:01 next day is 1).  int; NULL if either side is NULL."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def hour_diff(start, end) -> Column:
    """SC10 ``datediff('hour', start, end)``: hour boundaries crossed
    (00:59 -> 01:01 is 1).  Wall-clock arithmetic, no time zone involved."""
    s, e = _c(start), _c(end)
    days = F.datediff(F.to_date(e), F.to_date(s)).cast("long")
    return days * 24 + (F.hour(e) - F.hour(s)).cast("long")


def trunc_ts(unit: str, col) -> Column:
    """SC11 ``date_trunc(unit, ts)`` on a zone-less timestamp, zone-less out.

    Computed from the wall-clock fields (Spark's ``date_trunc`` goes through
    the session time zone), so daylight-saving days truncate correctly."""
    c = _c(col)
    u = unit.upper()
    if u in ("YEAR", "QUARTER", "MONTH", "WEEK"):
        return F.trunc(F.to_date(c), u).cast("timestamp_ntz")
    if u == "DAY":
        return F.to_date(c).cast("timestamp_ntz")
    zero = F.lit(0)
    parts = {"HOUR": (F.hour(c), zero, zero), "MINUTE": (F.hour(c), F.minute(c), zero),
             "SECOND": (F.hour(c), F.minute(c), F.floor(F.second(c)))}[u]
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), *parts)


def months_back(date_col, months: int) -> Column:
    """SC12 ``dateadd('month', -n, d)``; month end clamps (Aug 31 -> Feb 28)."""
    return F.add_months(_c(date_col), -months)
