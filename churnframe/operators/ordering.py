"""Exact order statistics without a single-partition window.

``Window.orderBy(x)`` with no partition key moves every row into one task.
Everything order-dependent here (running totals for the PR curve and AUC,
dense surrogate keys, exact medians and quartiles) goes through
``cumulative_sums`` instead:

1. the (pre-aggregated) input is cut into ``P`` value ranges whose split
   points come from one approximate-quantile pass (P-1 numbers reach the
   driver), so ranges hold about the same number of rows;
2. a window partitioned by (group, range) computes the running total inside
   each range -- many tasks in parallel;
3. per-range totals (groups x P rows) are turned into offsets with a window
   over that small table and added back through a broadcast join.

The answer is exact; the approximation only affects how evenly work is
spread.  Callers must pre-aggregate so (group, order value) is unique: a hot
value then becomes a single row instead of a skewed range.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnframe.session import materialize, maybe_broadcast


# Rows sorted by one window task; the number of ranges follows the row count.
ROWS_PER_RANGE = 200_000


def _range_buckets(df: DataFrame, key_col: str, n_buckets: int) -> DataFrame:
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = df.approxQuantile(key_col, probs, 1.0 / (4 * n_buckets)) if probs else []
    cuts = sorted({c for c in cuts if c is not None and math.isfinite(c)})
    if not cuts:
        return df.withColumn("_bucket", F.lit(0.0))
    splits = [float("-inf")] + cuts + [float("inf")]
    return Bucketizer(splits=splits, inputCol=key_col, outputCol="_bucket",
                      handleInvalid="keep").transform(df)


def cumulative_sums(df: DataFrame, order_col: str, sum_cols, group_cols=(),
                    descending: bool = False, n_buckets: int | None = None,
                    prefix: str = "cum_", materialize_input: bool = True,
                    tie_cols=()) -> DataFrame:
    """Add ``prefix+c`` = sum of ``c`` over rows of the same group whose order
    value is <= the current one (>= when ``descending``), current row included.

    ``order_col`` must be numeric and non-null; (order value, ``tie_cols``)
    must be unique within each group.  Rows are ordered by the column itself;
    its double only chooses the range, and values with equal doubles share a
    range, so integers beyond 2**53 keep their exact order.
    The input is read three times (split points, running totals, range
    totals), so it is first written once to the shared checkpoint folder
    unless the caller already did."""
    group_cols = list(group_cols)
    if materialize_input:
        df = materialize(df, "ordered_input")
    sum_cols = list(sum_cols)
    # the input is written, so the count comes from file metadata; at least two
    # ranges, so that every input takes the same plan
    p = n_buckets or max(2, math.ceil(df.count() / ROWS_PER_RANGE))
    key = F.col(order_col).cast("double")
    native = F.col(order_col).desc() if descending else F.col(order_col).asc()
    keyed = df.withColumn("_key", -key if descending else key)
    b = _range_buckets(keyed, "_key", p)
    part = group_cols + ["_bucket"]

    within = (Window.partitionBy(*part).orderBy(native, *tie_cols)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(c).over(within).alias(f"_loc_{c}") for c in sum_cols])

    totals = b.groupBy(*part).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    before = (Window.partitionBy(*group_cols).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*part, *[
        F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
        for c in sum_cols])
    # without groups offsets hold at most P rows: a proven bound.  With groups
    # (groups x P rows) AQE measures the aggregated size and picks the join.
    if not group_cols:
        offsets = F.broadcast(offsets)
    out = local.join(offsets, part, "inner")
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(prefix + c) for c in sum_cols])


def dense_index(df: DataFrame, order_col: str, name: str = "idx",
                n_buckets: int | None = None) -> DataFrame:
    """1-based position of each row when ordered by a unique numeric column
    (exact ``row_number() OVER (ORDER BY order_col)`` computed in parallel)."""
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    out = cumulative_sums(ones, order_col, ["_one"], n_buckets=n_buckets, prefix="_cum")
    return out.withColumnRenamed("_cum_one", name).drop("_one")


def lerp(lo, hi, t):
    """Linear interpolation as numpy computes it: from the nearer end, so the
    result is monotone in t and exact at both ends."""
    return F.when(t >= 0.5, hi - (hi - lo) * (F.lit(1.0) - t)).otherwise(lo + (hi - lo) * t)


def exact_quantiles(df: DataFrame, value_col: str, probs, group_cols=(),
                    n_buckets: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (position (n-1)*p), the numpy/pandas default.  NULLs are ignored.

    Returns one row per (group, p): ``group_cols..., p, value``.  Work is a
    group-by on (group, value) plus ``cumulative_sums``; no group is ever
    gathered into one task."""
    group_cols = list(group_cols)
    v = F.col(value_col)
    counts = materialize(
        df.where(v.isNotNull() & ~F.isnan(v.cast("double")))
        .groupBy(*group_cols, v.cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n")), "value_counts")
    cum = cumulative_sums(counts, "_v", ["_n"], group_cols, n_buckets=n_buckets,
                          materialize_input=False)
    cum = cum.withColumn("_prev", F.col("cum__n") - F.col("_n"))

    sizes = counts.groupBy(*group_cols).agg(F.sum("_n").alias("_size"))
    targets = (sizes.select(*group_cols, "_size",
                            F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("p"))
               .withColumn("_pos", (F.col("_size") - 1) * F.col("p"))
               .withColumn("_lo", F.floor("_pos"))
               .withColumn("_hi", F.ceil("_pos"))
               .withColumn("_frac", F.col("_pos") - F.col("_lo")))
    if group_cols:
        # (groups x probs) rows, written and counted: with few groups a shuffle
        # by group would read each in one task (AQE gives up the broadcast when
        # most of the other side's partitions are empty)
        joined = cum.join(maybe_broadcast(materialize(targets, "quantile_targets")), group_cols, "inner")
    else:
        # a single size: bring the handful of target ranks in as literals
        rows = targets.select("p", "_lo", "_hi", "_frac").collect()
        if not rows:
            return targets.select("p", F.lit(None).cast("double").alias("value"))
        aggs, fracs = [], []
        for i, r in enumerate(rows):
            lo, hi = int(r["_lo"]), int(r["_hi"])
            sel_lo = (F.col("_prev") <= lo) & (F.col("cum__n") > lo)
            sel_hi = (F.col("_prev") <= hi) & (F.col("cum__n") > hi)
            aggs += [F.max(F.when(sel_lo, F.col("_v"))).alias(f"_lo{i}"),
                     F.max(F.when(sel_hi, F.col("_v"))).alias(f"_hi{i}")]
            fracs.append((float(r["p"]), float(r["_frac"])))
        agg = cum.agg(*aggs)
        exprs = []
        for i, (p, frac) in enumerate(fracs):
            lo_v = F.col(f"_lo{i}")
            hi_v = F.col(f"_hi{i}")
            exprs.append(F.struct(F.lit(p).alias("p"),
                                  lerp(lo_v, hi_v, F.lit(frac)).alias("value")))
        return agg.select(F.explode(F.array(*exprs)).alias("_q")).select("_q.p", "_q.value")
    sel_lo = (F.col("_prev") <= F.col("_lo")) & (F.col("cum__n") > F.col("_lo"))
    sel_hi = (F.col("_prev") <= F.col("_hi")) & (F.col("cum__n") > F.col("_hi"))
    picked = (joined.where(sel_lo | sel_hi)
              .groupBy(*group_cols, "p", "_frac")
              .agg(F.max(F.when(sel_lo, F.col("_v"))).alias("_vlo"),
                   F.max(F.when(sel_hi, F.col("_v"))).alias("_vhi")))
    return picked.select(*group_cols, "p",
                         lerp(F.col("_vlo"), F.col("_vhi"), F.col("_frac")).alias("value"))
