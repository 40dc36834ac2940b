"""Declarative data checks (DQ1-DQ5).

A check is attached to a table and a column; its violations are a DataFrame,
and ``failures`` counts what the check reports:

* ``not_null``         — the rows where the column is NULL (failures: rows)
* ``unique``           — ``(value, n_records)`` per non-NULL value seen twice
                          or more (failures: such values)
* ``accepted_values``  — ``(value, n_records)`` per distinct non-NULL value
                          outside the list, compared as text (failures: values)
* ``relationships``    — ``(value, n_records)`` per non-NULL child key with no
                          parent row (failures: child rows, ``sum(n_records)``)

Every check aggregates before it shuffles: unique and accepted values group by
value with map-side combining; relationships pre-aggregates child keys to
(key, rows) and anti-joins them against the distinct parent keys, so a hot
child key is one row in the join.  ``run_suite`` returns one summary
row per check; nothing is collected on the way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.operators import key_filter, key_scan
from martforge.session import checkpoint_dir


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    values: tuple = ()
    to_model: str | None = None
    to_field: str | None = None

    @property
    def name(self) -> str:
        if self.test == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_model}_{self.to_field}"
        return f"{self.test}_{self.model}_{self.column}"


@dataclass
class Suite:
    checks: list[Check] = field(default_factory=list)

    def add(self, model: str, column: str, *tests) -> "Suite":
        for t in tests:
            if isinstance(t, str):
                self.checks.append(Check(model, column, t))
            else:
                self.checks.append(Check(model, column, *t))
        return self


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    """DQ1: the failing rows themselves."""
    return df.filter(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """DQ2: ``(value, n_records)`` for each non-NULL value seen twice or more."""
    return (
        df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def _not_accepted(col: Column, values: Sequence) -> Column:
    return col.isNotNull() & ~col.cast("string").isin([str(v) for v in values])


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """DQ3: ``(value, n_records)`` per value outside ``values``; NULL passes."""
    return (
        df.filter(_not_accepted(F.col(column), values))
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    )


def relationship_violations(child: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    """DQ4: ``(value, n_records)`` per orphan child key; NULL keys pass.
    ``failures`` of the check is ``sum(n_records)`` (child rows)."""
    keys = (
        child.select(F.col(column).alias("value")).filter(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(field_).alias("value")).filter(F.col("value").isNotNull()).distinct()
    return keys.join(parents, "value", "left_anti")


SUMMARY_SCHEMA = "model string, column_name string, test string, check_name string"


UNIQUE, CHILD, PARENT = 0, 1, 2
#: bits of the filter of suspect keys: 2 MB whatever the data; more suspects than it holds let more keys into the exact count
SUSPECT_BITS = 1 << 24


def _keyed(df: DataFrame, roles: Sequence[tuple[int, int, int, str]]) -> DataFrame:
    """``(check_id, role, value, print)``: one row per row and (check, role) pair,
    non-NULL values only, values as text so keys of different checks share one
    column.  The check travels the shuffle as a small int, not as its name."""
    kv = F.explode(F.array(*[
        F.struct(F.lit(i).alias("check_id"), F.lit(role).alias("role"), F.col(c).cast("string").alias("value"),
                 key_scan.fingerprint(F.lit(domain), F.lit(role == UNIQUE), key_scan.key_hash(c)).alias("print"))
        for i, role, domain, c in roles]))
    return df.select(kv.alias("kv")).select("kv.*").filter(F.col("value").isNotNull())


def _suspect_keys(tables: Mapping[str, DataFrame], roles: Mapping[str, Sequence[tuple[int, int, int, str]]]) -> tuple[set[int], DataFrame]:
    """The domains with keys that can fail their check, and a bitmap (``key_filter``) of those keys.

    The suspects are written once (``checkpoint``), so the scan runs once; one
    number a domain comes to the driver."""
    kinds = {UNIQUE: "unique", CHILD: "child", PARENT: "parent"}
    scans = []
    for model, listed in roles.items():
        parts = {key_scan.KeyRole(domain, c, kinds[role]): None for _, role, domain, c in listed}  # a parent of several checks goes once
        scans.append((tables[model], list(parts)))
    checkpoint_dir(scans[0][0].sparkSession)
    found = key_scan.suspects(scans).checkpoint()
    domains = {r["domain"] for r in found.select("domain").distinct().collect()}
    return domains, key_filter.build(found.select(F.xxhash64("domain", "print").alias("print")), "print", SUSPECT_BITS)


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], prepass: bool = True) -> DataFrame:
    """DQ5: one row per check — ``model, column_name, test, check_name,
    failures, passed`` — as a single DataFrame.

    * not-null and accepted-values checks of a model: one aggregation pass;
    * unique checks and both sides of every relationship: a first pass sends a
      few bytes a key (``key_scan``) and finds the keys that can fail; it runs
      at once.  The second counts those exactly, by their text, in one shuffle
      on ``(check, value)`` (counted map-side first, so a hot key is one row a
      task).  Keys that the first pass clears are not shuffled as text, and
      tables without suspects are not read again.
    So a table is read at most three times, twice of them for its key columns
    only.  ``prepass=False`` sends every key to the exact count.  Checks without
    failures get 0 from the (bounded) list of checks."""
    spark = next(iter(tables.values())).sparkSession
    index = {c.name: i for i, c in enumerate(checks)}
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)

    failures: list[DataFrame] = []
    for model, cs in by_model.items():
        row_checks = [c for c in cs if c.test in ("not_null", "accepted_values")]
        if not row_checks:
            continue
        aggs = []
        for i, c in enumerate(row_checks):
            col = F.col(c.column)
            if c.test == "not_null":
                aggs.append(F.count_if(col.isNull()).alias(f"f{i}"))
            else:
                aggs.append(F.count_distinct(F.when(_not_accepted(col, c.values), col.cast("string"))).alias(f"f{i}"))
        wide = tables[model].agg(*aggs)
        stack = F.explode(F.array(*[F.struct(F.lit(index[c.name]).alias("check_id"),
                                             F.col(f"f{i}").alias("failures"))
                                    for i, c in enumerate(row_checks)]))
        failures.append(wide.select(stack.alias("r"))
                        .select("r.check_id", F.col("r.failures").cast("long").alias("failures")))

    roles: dict[str, list[tuple[int, int, int, str]]] = {}
    parents: dict[tuple[str, str], int] = {}
    for c in checks:
        i = index[c.name]
        if c.test == "unique":
            roles.setdefault(c.model, []).append((i, UNIQUE, i, c.column))
        elif c.test == "relationships":
            domain = parents.setdefault((c.to_model, c.to_field), len(checks) + len(parents))
            roles.setdefault(c.model, []).append((i, CHILD, domain, c.column))
            roles.setdefault(c.to_model, []).append((i, PARENT, domain, c.to_field))
    suspect = None
    if roles and prepass:
        domains, suspect = _suspect_keys(tables, roles)
        roles = {m: left for m, r in roles.items() if (left := [x for x in r if x[2] in domains])}
    if roles:
        rows = reduce(DataFrame.unionByName, [_keyed(tables[m], r) for m, r in roles.items()])
        if suspect is not None:
            rows = key_filter.keep_possible(rows, "print", suspect, SUSPECT_BITS)
        keys = rows.groupBy("check_id", "value").agg(F.count_if(F.col("role") != PARENT).alias("n"), F.max("role").alias("role"))
        bad = keys.filter(((F.col("role") == UNIQUE) & (F.col("n") > 1)) | (F.col("role") == CHILD))
        failures.append(bad.groupBy("check_id").agg(
            F.sum(F.when(F.col("role") == CHILD, F.col("n")).otherwise(1)).cast("long").alias("failures")))

    listed = spark.createDataFrame([(i, c.model, c.column, c.test, c.name) for i, c in enumerate(checks)],
                                   "check_id int, " + SUMMARY_SCHEMA)
    found = reduce(DataFrame.unionByName, failures)
    return (listed.join(found, "check_id", "left")
            .select("model", "column_name", "test", "check_name",
                    F.coalesce(F.col("failures"), F.lit(0).cast("long")).alias("failures"))
            .withColumn("passed", F.col("failures") == 0))
