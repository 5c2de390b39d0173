"""Histogram limits at rounded values, never more bins than asked for."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnframe.operators.profile import _multiple, rounded_histogram, rounded_width

num = st.floats(-1e9, 1e9, allow_nan=False)


@settings(max_examples=300, deadline=None)
@given(num, num, st.integers(2, 60))
def test_smallest_width_that_fits(a, b, n):
    lo, hi = min(a, b), max(a, b)
    m, k = rounded_width(lo, hi, n)
    if hi > lo:
        assert _multiple(hi, m, k) - _multiple(lo, m, k) < n
    if hi - lo > 1e-6 * max(abs(lo), abs(hi), 1):
        smaller = {1: (5, k - 1), 2: (1, k), 5: (2, k)}[m]
        assert _multiple(hi, *smaller) - _multiple(lo, *smaller) >= n


def test_one_bin_is_two_around_zero():
    assert rounded_width(-1.0, 1.0, 1) == rounded_width(-1.0, 1.0, 2) == (2, 0)


def test_histogram(spark):
    inf = float("inf")
    df = spark.createDataFrame([(0.1 * i, i % 2) for i in range(100)] + [(None, 0), (float("nan"), 1), (inf, 1), (-inf, 0)],
                               "v double, g int")
    rows = rounded_histogram(df, "v", "g", 10).orderBy("bin", "g").collect()
    assert sum(r.n for r in rows) == 100 and {r.bin for r in rows} == set(range(10))
    assert all(r.bin_start == r.bin and r.bin_end == r.bin + 1 and r.n == 5 for r in rows)
    fine = rounded_histogram(df, "v", "g", 60).collect()
    assert {round(r.bin_end - r.bin_start, 9) for r in fine} == {0.2} and len({r.bin for r in fine}) <= 60
    assert rounded_histogram(df.limit(0), "v", "g").count() == 0
    same = rounded_histogram(df.withColumn("v", F.lit(7)), "v", "g").collect()
    assert {(r.bin, r.bin_start, r.bin_end, r.n) for r in same} == {(0, 7.0, 8.0, 52)}
