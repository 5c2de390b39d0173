"""A third of all rows on one key: results stay whole and correct."""

from pyspark.sql import functions as F

from churnframe.operators import star as S
from churnframe.operators.analytics import churn_by_contract
from churnframe.operators.view import training_view
from churnframe.plans.datasets import datasets


def test_hot_customer(spark, sf):
    st = datasets(spark, sf).staging
    n = st.count()
    hot = st.where(F.col("row_id") % 3 == 0).withColumn("customer_id", F.lit("HOT"))
    skewed = st.where(F.col("row_id") % 3 != 0).unionByName(hot)
    star = S.load_star(skewed, materialize_result=False)
    dc = star.dim_customer.where(F.col("customer_id") == "HOT").collect()
    first = hot.agg(F.min("row_id")).first()[0]
    assert len(dc) == 1 and dc[0].customer_key == first
    assert star.fact.count() == n                      # no row dropped or duplicated
    rows = churn_by_contract(training_view(star)).collect()
    assert sum(r.customers for r in rows) == n
