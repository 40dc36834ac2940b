"""Text cleaning (SC1-SC3, IO3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that the raw loader reads as NULL (besides an empty field).
NULL_TOKENS = ["", "NULL", "null", "NA", "N/A"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_lower(col) -> Column:
    """SC1 ``lower(trim(x))``; trim removes spaces only."""
    return F.lower(F.trim(_c(col)))


def clean_upper(col) -> Column:
    """SC2 ``upper(trim(x))``."""
    return F.upper(F.trim(_c(col)))


def blank_to_null(col) -> Column:
    """SC3 ``nullif(trim(x), '')``."""
    return F.nullif(F.trim(_c(col)), F.lit(""))


def null_tokens_to_null(col, tokens=None) -> Column:
    """IO3: a raw field equal to one of the NULL tokens becomes NULL."""
    c = _c(col)
    return F.when(c.isin(tokens or NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)
