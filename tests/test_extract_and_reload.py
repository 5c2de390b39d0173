"""Landed extracts of any shape; reloading a stored star; request defaults."""

import pytest
from pyspark.sql import functions as F

from churnframe.functions.bands import tenure_band_cut
from churnframe.functions.coerce import safe_double
from churnframe.functions.features import avg_monthly_spend
from churnframe.operators import star as S
from churnframe.operators.validate import validate_requests
from churnframe.plans.datasets import datasets
from churnframe.schema import REQUIRED_HEADERS
from churnframe.session import scratch_path
from churnframe.sources.raw import ragged_records, read_raw


def _land(spark, lines):
    path = scratch_path(spark, "extract")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def _line(i, cols):
    return ",".join("7" if c == "extra" else str(i) if c == "row_id" else f"{c[:3]}{i}" for c in cols)


@pytest.mark.parametrize("cols", [list(reversed(REQUIRED_HEADERS)), ["extra", *REQUIRED_HEADERS],
                                  ["row_id", *REQUIRED_HEADERS, "extra"], list(REQUIRED_HEADERS)])
def test_any_order_extras_and_no_row_id(spark, cols):
    path = _land(spark, [",".join(cols)] + [_line(i, cols) for i in range(5)])
    rows = read_raw(spark, path).orderBy("row_id").collect()
    assert [r["CustomerID"] for r in rows] == [f"Cus{i}" for i in range(5)]
    assert [r["CLTV"] for r in rows] == [f"CLT{i}" for i in range(5)]
    if "row_id" in cols:
        assert [r["row_id"] for r in rows] == list(range(5))


def test_missing_columns_are_listed_together(spark):
    cols = [c for c in REQUIRED_HEADERS if c not in ("CLTV", "Gender")]
    path = _land(spark, [",".join(cols), _line(1, cols)])
    with pytest.raises(ValueError) as err:
        read_raw(spark, path)
    assert "CLTV" in str(err.value) and "Gender" in str(err.value)


def test_ragged_records_are_reported(spark):
    cols = list(REQUIRED_HEADERS)
    good, short, long = _line(1, cols), "a,b", _line(2, cols) + ",x"
    path = _land(spark, [",".join(cols), good, short, long])
    assert read_raw(spark, path).count() == 1
    assert {r.record for r in ragged_records(spark, path).collect()} == {short, long}


def test_second_batch_into_a_stored_star(spark, sf):
    st = datasets(spark, sf).staging
    path = scratch_path(spark, "star")
    first, second = st.where("row_id % 2 = 0"), st.where("row_id % 2 = 1")
    S.load_and_write(first, path)
    star = S.merge_and_write(path, second.withColumn("snapshot_date", F.lit("2026-02-28")))
    days = {r.snapshot_date: r["count"] for r in star.fact.groupBy("snapshot_date").count().collect()}
    assert days == {"2026-01-28": first.count(), "2026-02-28": second.count()}
    assert star.dim_customer.count() == st.select("customer_id").distinct().count()
    assert S.dq_duplicate_keys(star).count() == 0
    again = S.merge_and_write(path, second.withColumn("snapshot_date", F.lit("2026-02-28")))
    assert again.fact.count() == st.count()
    assert again.dim_customer.count() == star.dim_customer.count()


def test_rows_without_an_id_are_all_new(spark):
    cols = "customer_key long, customer_id string, gender string"
    old = spark.createDataFrame([(1, None, "M"), (2, "a", "M")], cols)
    new = spark.createDataFrame([(5, None, "F"), (6, "a", "F"), (7, "b", "F")], cols)
    got = S.merge_dimension(old, new, ["customer_id"], "customer_key").collect()
    assert sorted((r.customer_id or "", r.gender) for r in got) == [("", "F"), ("", "M"), ("a", "M"), ("b", "F")]


def test_omitted_mode_is_the_default(spark, sf):
    v = datasets(spark, sf).view_with(("customer", "contract", "services")).where("monthly_charges IS NOT NULL").limit(3)
    for df in (v, v.withColumn("mode", F.lit(None).cast("string"))):
        rows = validate_requests(df).select("mode", "is_valid").collect()
        assert {(r.mode, r.is_valid) for r in rows} == {("default", True)}


def test_padded_numbers_and_nan_tenure(spark):
    df = spark.createDataFrame([("\t12",), ("12\n",), (" 1.5\t",), ("\t",)], "x string")
    assert [r[0] for r in df.select(safe_double("x")).collect()] == [12.0, 12.0, 1.5, None]
    nan = spark.createDataFrame([(float("nan"), 100.0)], "tenure_months double, total_charges double")
    assert tuple(nan.select(tenure_band_cut(), avg_monthly_spend()).first()) == ("0-12", 0.0)


def test_hot_customer_in_a_stored_star_goes_through_a_shuffle(spark, sf):
    from churnframe.operators.view import training_view
    st = datasets(spark, sf).staging
    hot = st.withColumn("customer_id", F.when(F.col("row_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("customer_id")))
    star = S.load_and_write(hot, scratch_path(spark, "hot-star"))
    assert star.fact.count() == st.count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = training_view(star, dims=("customer",))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning(customer_key" in plan
