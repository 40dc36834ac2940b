"""Data-check queries (DQ1-DQ5) over the models derived from the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martforge.operators import checks
from martforge.plans.build import Staged, staged_models
from martforge.plans.graph import models
from martforge.plans.rules import ORDER_STATUSES, model_suite
from martforge.session import shuffles_released
from martforge.sources.testdata import raw_orders, raw_tables

AS_OF = "2001-08-01"


def _models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return models(raw_tables(spark, sf_dir), as_of=AS_OF)


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ1: orders whose purchase time did not parse."""
    return checks.not_null_violations(_models(spark, sf_dir)["stg_orders"], "purchased_at")


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ2: review ids that repeat."""
    return checks.unique_violations(_models(spark, sf_dir)["stg_order_reviews"], "review_id")


def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ3: raw (uncleaned) order statuses outside the accepted list."""
    return checks.accepted_values_violations(raw_orders(spark, sf_dir), "order_status", ORDER_STATUSES)


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ4: orders whose customer id has no customer row."""
    m = _models(spark, sf_dir)
    return checks.relationship_violations(m["stg_orders"], "customer_id", m["stg_customers"], "customer_id")


def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ5: all 81 model checks, one summary row each.

    As in a build, the shared intermediates (``orders_enriched``, the zip
    centroids, the two roll-ups) are written once to the shared checkpoint
    folder and read back rather than re-planned under every check.  The summary
    has one row per check, so it is brought to the driver and the staged
    folder deleted."""
    staged = Staged(spark)
    with shuffles_released(spark):
        summary = checks.run_suite(staged_models(spark, raw_tables(spark, sf_dir), AS_OF, staged=staged), model_suite().checks)
        rows = summary.collect()
    staged.delete()
    return spark.createDataFrame(rows, summary.schema)


QUERIES = {
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted_values": check_accepted_values,
    "check_relationships": check_relationships,
    "check_suite": check_suite,
}
