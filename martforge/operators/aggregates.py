"""Aggregate operators: arg-max (AG8), mode (AG9), conditional counts (AG10/14)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions.text import _c


def arg_max(value, order: Sequence, numeric_order: bool = False) -> Column:
    """AG8 ``max_by(value, order)`` with a total order.

    ``order`` is a list of columns compared left to right (the first is the
    real ordering, the rest break ties).  Rows whose first ordering column is
    NULL are ignored; a group with no ordered row gives NULL.  With
    ``numeric_order`` the first column is compared as a number instead of as
    text (text order makes '9' beat '10'); text that is not a number is then
    unordered and ignored.
    """
    cols = [_c(c) for c in order]
    if numeric_order:
        cols[0] = cols[0].try_cast("decimal(38,10)")
    key = F.when(cols[0].isNotNull(), F.struct(*cols))
    return F.max_by(_c(value), key)


def modes_per_key(df: DataFrame, key: str, modes: Mapping[str, Column],
                  measures: Mapping[str, Column] | None = None) -> DataFrame:
    """AG9 ``mode(x)`` for several columns per key, plus exact sums and counts
    of numeric measures (for averages), in one scan and two shuffles, no join.

    Every input row is unpivoted into one entry per mode column (its value)
    and one base entry carrying the measures.  Level 1 counts entries per
    ``(key, kind, value)`` with map-side combining — a hot key is spread over
    its distinct values.  Level 2 takes, per key and mode, the value with the
    highest count (the smallest on a tie) and adds up the measures.  NULL
    values are ignored; a key whose values are all NULL gets a NULL mode; a
    NULL key is a group of its own, as in GROUP BY.

    Output: ``key``, one column per mode (its input type), and
    ``<measure>_sum`` / ``<measure>_count`` per measure.
    """
    measures = dict(measures or {})
    types = {name: df.select(col).schema.fields[0].dataType for name, col in modes.items()}
    mtypes = {name: df.select(col).schema.fields[0].dataType for name, col in measures.items()}

    def entry(kind: str, value: Column, with_measures: bool) -> Column:
        fields = [F.lit(kind).alias("__kind"), value.cast("string").alias("__v")]
        for m, col in measures.items():
            fields.append((col if with_measures else F.lit(None).cast(mtypes[m])).alias(f"__m_{m}"))
        return F.struct(*fields)

    entries = [entry("", F.lit(None), True)] + [entry(name, col, False) for name, col in modes.items()]
    rows = df.select(F.col(key), F.explode(F.array(*entries)).alias("__e")).select(key, "__e.*")
    rows = rows.filter((F.col("__kind") == "") | F.col("__v").isNotNull())
    level1 = rows.groupBy(key, "__kind", "__v").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(f"__m_{m}").alias(f"__s_{m}") for m in measures],
        *[F.count(f"__m_{m}").alias(f"__c_{m}") for m in measures],
    )
    out = []
    for name in modes:
        pick = F.when(F.col("__kind") == name, F.struct(-F.col("__n"), F.col("__v")))
        out.append(F.min_by(F.col("__v"), pick).cast(types[name]).alias(name))
    for m in measures:
        out += [F.sum(f"__s_{m}").alias(f"{m}_sum"), F.sum(f"__c_{m}").cast("long").alias(f"{m}_count")]
    return level1.groupBy(key).agg(*out)


def mode_per_key(df: DataFrame, key: str, value, alias: str) -> DataFrame:
    """AG9 ``mode(value)`` per key: the most common non-NULL value, the
    smallest on a tie (NULL when a key has no value)."""
    return modes_per_key(df, key, {alias: _c(value)})


def conditional_counts(conditions: Mapping[str, Column]) -> list[Column]:
    """AG10/AG14 ``count(case when p then 1 end)`` per named predicate; a NULL
    predicate is not counted."""
    return [F.count_if(F.coalesce(p, F.lit(False))).alias(name) for name, p in conditions.items()]
