"""Joins with a handful of groups: no task may read a whole group, so the rows
are not shuffled by group."""

import re

import pytest


@pytest.fixture
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", old)


def _by_group_only(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"(?:SortMerge|ShuffledHash)Join \[grp#\d+L?\],", plan)


def _rows(spark):
    return spark.range(0, 4000, 1, 8).selectExpr("id % 2 AS grp", "CAST(id AS DOUBLE) AS v")


def test_box_stats_keeps_rows_where_they_are(many_partitions):
    from churnframe.operators.profile import box_stats
    out = box_stats(_rows(many_partitions), "v", "grp")
    assert _by_group_only(out) == []
    assert {r.grp: (r.n, r.q1, r.median, r.q3, r.n_outliers) for r in out.collect()} == {
        0: (2000, 999.5, 1999.0, 2998.5, 0), 1: (2000, 1000.5, 2000.0, 2999.5, 0)}


def test_quantiles_keep_rows_where_they_are(many_partitions):
    from churnframe.operators.ordering import exact_quantiles
    out = exact_quantiles(_rows(many_partitions), "v", [0.5], ["grp"])
    assert _by_group_only(out) == []
    assert {r.grp: r.value for r in out.collect()} == {0: 1999.0, 1: 2000.0}


def test_rows_of_a_null_group_have_no_box(spark):
    from churnframe.operators.profile import box_stats
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, 3.0), (1, None), (1, float("nan"))], "grp int, v double")
    assert [(r.grp, r.n, r.median) for r in box_stats(df, "v", "grp").collect()] == [(1, 1, 3.0)]
