"""Latest row per key (WN1 + FL2 + ST2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key group under ``order``.

    ``row_number() over (partition by keys order by ...) = 1``.  Spark plans
    this as a partial ``WindowGroupLimit`` before the shuffle and a final one
    after, so a hot key ships at most one row per map task.  ``order`` should be
    total (add tie-breakers) for a deterministic result.
    """
    rn = "__rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
