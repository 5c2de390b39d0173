"""Distributed order statistics against brute force."""

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from churnframe.operators.ordering import cumulative_sums, dense_index, exact_quantiles


def test_cumulative_sums_match_pandas(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 400), "v": rng.permutation(400).astype(float),
                        "w": rng.integers(0, 10, 400)})
    df = spark.createDataFrame(pdf)
    got = cumulative_sums(df, "v", ["w"], ["g"], n_buckets=5).toPandas()
    exp = pdf.sort_values("v").assign(cum_w=lambda d: d.groupby("g")["w"].cumsum())
    m = got.merge(exp, on=["g", "v", "w"], suffixes=("", "_e"))
    assert len(m) == 400 and (m["cum_w"] == m["cum_w_e"]).all()
    desc = cumulative_sums(df, "v", ["w"], descending=True, n_buckets=4).toPandas()
    exp2 = pdf.sort_values("v", ascending=False).assign(c=lambda d: d["w"].cumsum())
    m2 = desc.merge(exp2, on=["g", "v", "w"])
    assert (m2["cum_w"] == m2["c"]).all()


def test_dense_index(spark):
    df = spark.createDataFrame([(int(k),) for k in [50, 3, 17, 99, 4]], "k long")
    got = {r.k: r.idx for r in dense_index(df, "k", n_buckets=3).collect()}
    assert got == {3: 1, 4: 2, 17: 3, 50: 4, 99: 5}


def test_exact_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    q = {r.p: r.value for r in exact_quantiles(df, "x", [0.25, 0.5, 0.75]).collect()}
    assert q == {0.25: 1.75, 0.5: 2.5, 0.75: 4.75}
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 301), "x": rng.normal(size=301).round(2)})
    got = exact_quantiles(spark.createDataFrame(pdf), "x", [0.1, 0.5, 0.9], ["g"]).toPandas()
    for _, r in got.iterrows():
        exp = np.quantile(pdf.loc[pdf.g == r.g, "x"], r.p)
        assert abs(exp - r.value) < 1e-12


def test_mode_tie_smallest(spark):
    from churnframe.operators.profile import medians, most_frequent
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("a", 10.0)], "c string, x double")
    assert most_frequent(df, ["c"]).first().fill_value == "a"
    assert medians(df, ["x"]).first().median == 2.5


def test_many_ranges_and_empty_ranges(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 120), "v": rng.integers(0, 30, 120).astype(float)})
    pdf = pdf.drop_duplicates(["g", "v"]).assign(w=1)
    got = cumulative_sums(spark.createDataFrame(pdf), "v", ["w"], ["g"], n_buckets=64).toPandas()
    exp = pdf.sort_values("v").assign(c=lambda d: d.groupby("g")["w"].cumsum())
    m = got.merge(exp, on=["g", "v", "w"])
    assert len(m) == len(pdf) and (m["cum_w"] == m["c"]).all()
    q = exact_quantiles(spark.createDataFrame(pdf), "v", [0.0, 0.3, 1.0], ["g"], n_buckets=64)
    for _, r in q.toPandas().iterrows():
        assert r.value == np.quantile(pdf.loc[pdf.g == r.g, "v"], r.p)


def test_last_n_counts_and_large_ids(spark):
    from churnframe.operators import monitoring as M
    df = spark.createDataFrame([(i, float(i % 7) / 7, i % 2) for i in range(500)],
                               "id long, churn_probability double, churn_flag int")
    small = {r.churn_flag: (r["count"], r.avg_probability)
             for r in M.monitoring_summary(df, 123).collect()}
    assert sum(n for n, _ in small.values()) == 123
    for parts in (1, 7):
        big = df.withColumn("id", F.col("id") * 3 + F.lit(2 ** 54 + 1)).repartition(parts)
        got = sorted(r.id for r in M.last_n(big, 50).collect())
        assert got == [2 ** 54 + 1 + 3 * i for i in range(450, 500)]
    wide = spark.createDataFrame([(-2 ** 63,), (-5,), (0,), (7,), (2 ** 63 - 1,)], "id long")
    assert [M.nth_largest(wide, n) for n in range(1, 7)] == [2 ** 63 - 1, 7, 0, -5, -2 ** 63, None]
    assert sorted(r.id for r in M.last_n(df, 123).collect()) == list(range(377, 500))
    assert M.last_n(df, 0).count() == 0 and M.last_n(df, 1000).count() == 500


def test_last_n_above_a_hundred_thousand(spark):
    from churnframe.operators import monitoring as M
    ids = spark.range(0, 400_000).select((F.col("id") * 11).alias("id"))
    got = M.last_n(ids, 150_000).agg(F.count("id"), F.min("id")).first()
    assert tuple(got) == (150_000, 250_000 * 11)


def test_dense_index_beyond_double_precision(spark):
    ids = [2 ** 54 + i for i in range(200)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "k long")
    for buckets in (None, 8):
        got = {r.k: r.idx for r in dense_index(df, "k", n_buckets=buckets).collect()}
        assert got == {k: i + 1 for i, k in enumerate(ids)}
