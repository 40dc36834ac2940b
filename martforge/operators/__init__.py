"""Generic DataFrame operators; column names are parameters so each works on
any table, not only on the retail models."""

from martforge.operators.latest import latest_per_key
from martforge.operators.aggregates import arg_max, mode_per_key, modes_per_key, conditional_counts
from martforge.operators.windows import rolling_rows_avg, period_to_date_sum, running_total

__all__ = [
    "latest_per_key", "arg_max", "mode_per_key", "modes_per_key", "conditional_counts",
    "rolling_rows_avg", "period_to_date_sum", "running_total",
]
