"""Surrogate keys (SC20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.functions.text import _c

# The key is md5 over the parts joined by this separator, with
# a NULL part replaced by this token, so keys equal the reference's keys.
KEY_SEPARATOR = "-"
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols) -> Column:
    """32-hex-char md5 of the parts as text."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))
