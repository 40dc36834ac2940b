"""Casts from raw text (SC5-SC8).  ANSI mode is on: malformed numbers raise,
timestamps go through the ``try_`` form and become NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.text import _c


def to_double(col) -> Column:
    """SC5 ``x::float`` — a 64-bit double; bad text raises under ANSI."""
    return _c(col).cast("double")


def to_int(col) -> Column:
    """SC6 ``x::integer``: text with a fraction is rounded half away from zero,
    text that is not a number raises."""
    return F.round(_c(col).cast("decimal(38,10)"), 0).cast("int")


# Text holding only an integer is a time since the Unix epoch,
# its unit picked by magnitude — below the first limit seconds, then
# milliseconds, microseconds, and nanoseconds from the last limit on; a
# negative integer is always seconds.
EPOCH_UNIT_LIMITS = (31536000000, 31536000000000, 31536000000000000)
_MIN_MICROS, _MAX_MICROS = -62135596800000000, 253402300799999999  # 0001-01-01 .. 9999-12-31 23:59:59.999999


def to_timestamp(col) -> Column:
    """SC7 ``try_to_timestamp(x)`` as a zone-less timestamp; unparsable -> NULL.

    Date/time text parses straight to a zone-less value (date-only text is
    midnight; a zone suffix is ignored), so the session time zone plays no
    part — no daylight-saving shift; integer text is epoch time (see
    ``EPOCH_UNIT_LIMITS``), computed on the zone-less epoch.  Of the other
    documented automatic formats these parse too: ``MM/DD/YYYY`` with or
    without a time (24 hours, or 12 with AM/PM), ``DD-MON-YYYY``, mail dates
    (``Thu, 21 Dec 2000 16:01:07 +0200``, with AM/PM or fractions of a second
    too) and ``Mon Jul 08 18:09:51 +0000 2013``.  A year and month alone is no
    documented format: NULL."""
    c = _c(col)
    t = F.trim(c)
    n = F.when(t.rlike(r"^[+-]?[0-9]{1,30}$"), t.cast("decimal(38,0)"))
    s1, s2, s3 = EPOCH_UNIT_LIMITS
    micros = (F.when(n < 0, n * 1000000).when(n < s1, n * 1000000).when(n < s2, n * 1000)
              .when(n < s3, n).otherwise(F.floor(n / 1000)))
    in_range = micros.between(_MIN_MICROS, _MAX_MICROS)
    epoch = F.timestamp_add("MICROSECOND", F.when(in_range, micros).cast("long"),
                            F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    # the year moves to the front of the time, as in a mail date
    unix = F.regexp_replace(t, r"^[A-Za-z]{3} ([A-Za-z]{3}) +([0-9]{1,2}) ([0-9:.]+) ([+-][0-9]{4}|[A-Z]{3}) ([0-9]{4})$", "$2 $1 $5 $3")
    mail = F.regexp_replace(F.regexp_replace(unix, r"^[A-Za-z]{3},? +", ""), r" +([+-][0-9]{4}|[A-Z]{3})$", "")
    # fixed values: day-first and month-first forms, each with its times
    forms = [(t, "M/d/yyyy"), (t, "d-MMM-yyyy")]
    forms += [(t, f"M/d/yyyy {time}") for time in ("H:m:s", "H:m", "h:m:s a", "h:m a")]
    forms += [(mail, f"d MMM yyyy {time}") for time in ("H:m:s", "H:m:s.SSSSSS", "h:m:s a", "h:m:s.SSSSSS a")]
    other = F.coalesce(*[F.try_to_timestamp(text, F.lit(form)) for text, form in forms]).cast("timestamp_ntz")
    return (F.when(n.isNotNull(), epoch)
            .when(t.rlike(r"^[0-9]{4}-[0-9]{1,2}$"), F.lit(None).cast("timestamp_ntz"))
            .when(t.rlike(r"^[0-9]{4}-"), c.try_cast("timestamp_ntz"))
            .when(t.rlike(r"^([0-9]|[A-Za-z]{3},? )"), F.coalesce(c.try_cast("timestamp_ntz"), other))
            .otherwise(c.try_cast("timestamp_ntz")))
