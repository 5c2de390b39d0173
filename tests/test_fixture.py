"""Expected facts of the derived fixtures (FIXTURES sections 1 and 3)."""

from pyspark.sql import functions as F

from churnframe.plans.catalog import QUERIES
from churnframe.plans.datasets import datasets


def test_subscriber_facts(spark, sf):
    s = datasets(spark, sf).subscriber
    r = s.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("customer_id").alias("c"),
              F.count("total_charges").alias("t"),
              F.sum((F.col("churn_label") == "Yes").cast("int")).alias("y"),
              F.sum("tenure_months").alias("ten")).first()
    assert (r.n, r.c, r.t, r.y, r.ten) == (1500, 150, 1483, 367, 60501)


def test_star_key_counts(spark, sf):
    star = datasets(spark, sf).star
    assert star.dim_contract.count() == 24
    assert star.dim_services.count() == 196
    assert star.fact.count() == 1500


def test_monitoring_last_1000(spark, sf):
    got = {r.churn_flag: r["count"] for r in QUERIES["monitoring_summary"](spark, sf).collect()}
    assert got == {0: 656, 1: 344}


def test_policy_thresholds(spark, sf):
    b80 = QUERIES["best_threshold_080"](spark, sf).first()
    assert b80.threshold == 0.734375
    assert round(b80.precision, 4) == 0.5600 and round(b80.recall, 4) == 0.8011
    b85 = QUERIES["best_threshold_085"](spark, sf).first()
    assert b85.threshold == 0.7109375
    assert round(b85.precision, 4) == 0.5491 and round(b85.recall, 4) == 0.8529


def test_flagship_entry(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert [r.contract_type for r in rows][0] == "Month-to-month"
    assert sum(r.customers for r in rows) == 1500
