"""SQL over the registered view; prediction-log table append."""

from pyspark.sql import functions as F

from churnframe.operators.monitoring import append_log, monitoring_summary
from churnframe.operators.view import register_view
from churnframe.plans.datasets import datasets
from churnframe.session import scratch_path


def test_sql_over_registered_view(spark, sf):
    register_view(datasets(spark, sf).star)
    view = datasets(spark, sf).view
    got = spark.sql("SELECT state, max(cltv) AS top, count_if(gender = 'Male') AS men "
                    "FROM vw_churn_training_dataset GROUP BY state").collect()
    want = view.groupBy("state").agg(F.max("cltv").alias("top"),
                                     F.count_if(F.col("gender") == "Male").alias("men")).collect()
    assert sorted(got) == sorted(want) and got


def test_append_log_creates_and_appends(spark, sf):
    log = datasets(spark, sf).prediction_log
    path = scratch_path(spark, "plog")
    append_log(log, path)
    append_log(log.withColumn("id", F.col("id") + 1_000_000), path)
    back = spark.read.parquet(path)
    assert back.count() == 2 * log.count()
    s = {r.churn_flag: r["count"] for r in monitoring_summary(back, 1000).collect()}
    assert sum(s.values()) == 1000


def test_stamp_requests_keeps_client_ids(spark):
    from churnframe.session import materialize
    from churnframe.streaming.scoring import stamp_requests
    df = spark.createDataFrame([("a1", 1), (None, 2), (None, 3)], "request_id string, x int")
    stamped = materialize(stamp_requests(df), "stamped")    # drawn once, then reused
    rows = {r.x: r for r in stamped.collect()}
    assert rows[1].request_id == "a1"
    assert rows[2].request_id and rows[3].request_id and rows[2].request_id != rows[3].request_id
    assert all(r.ts_utc is not None for r in rows.values())
    again = {r.x: r.request_id for r in stamped.collect()}
    assert again == {k: r.request_id for k, r in rows.items()}
