"""Data checks count seeded violations exactly once each."""

from martforge.operators.checks import (
    Check, accepted_values_violations, not_null_violations, relationship_violations, run_suite, unique_violations,
)
from martforge.plans.rules import model_suite


def test_each_check_counts_its_seed(spark):
    child = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, None, "zz"), (4, "b", None), (5, "c", "y")],
                                  "id int, k string, v string")
    parent = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    assert not_null_violations(child, "v").count() == 1
    assert [tuple(r) for r in unique_violations(child, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in accepted_values_violations(child, "v", ["x", "y"]).collect()] == [("zz", 1)]
    assert [tuple(r) for r in relationship_violations(child, "k", parent, "k").collect()] == [("c", 1)]
    checks = [Check("t", "v", "not_null"), Check("t", "k", "unique"), Check("t", "v", "accepted_values", ("x", "y")),
              Check("t", "k", "relationships", (), "p", "k"), Check("t", "id", "unique")]
    got = {r.check_name: (r.failures, r.passed) for r in run_suite({"t": child, "p": parent}, checks).collect()}
    assert got == {"not_null_t_v": (1, False), "unique_t_k": (1, False), "accepted_values_t_v": (1, False),
                   "relationships_t_k__p_k": (1, False), "unique_t_id": (0, True)}


def test_rule_inventory():
    from collections import Counter

    c = Counter(ch.test for ch in model_suite().checks)
    assert sum(c.values()) == 81
    assert c == {"not_null": 51, "unique": 16, "accepted_values": 9, "relationships": 5}


def test_a_lost_rule_is_noticed():
    """The oracle states its own rules, so the code's list is compared to it, not to itself."""
    from duck_oracle.checks import RULES
    from martforge.plans.rules import model_suite

    def text(c):
        more = [",".join(map(str, c.values))] if c.test == "accepted_values" else [f"{c.to_model}.{c.to_field}"] if c.test == "relationships" else []
        return " ".join([c.model, c.column, c.test, *more])

    stated = RULES.strip().split("\n")
    assert len(stated) == 81 and [text(c) for c in model_suite().checks] == stated
    assert [text(c) for c in model_suite().checks[1:]] != stated
