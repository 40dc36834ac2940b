"""Column -> Column helpers.  All are built-in Spark expressions (JVM side,
whole-stage codegen); no Python runs per row."""

from martforge.functions.text import clean_lower, clean_upper, blank_to_null, null_tokens_to_null
from martforge.functions.casts import to_double, to_int, to_timestamp
from martforge.functions.dates import day_diff, hour_diff, trunc_ts, months_back
from martforge.functions.keys import surrogate_key
from martforge.functions.numeric import (
    round_half_up, sum_money, avg_money, avg_exact, safe_ratio_pct, volumetric_weight,
)

__all__ = [
    "clean_lower", "clean_upper", "blank_to_null", "null_tokens_to_null",
    "to_double", "to_int", "to_timestamp",
    "day_diff", "hour_diff", "trunc_ts", "months_back",
    "surrogate_key",
    "round_half_up", "sum_money", "avg_money", "avg_exact", "safe_ratio_pct", "volumetric_weight",
]
