"""Data profiling.

Per-column statistics are computed in one pass over a long ``(column, value)``
form instead of one job per column; quantiles are exact (linear
interpolation) through ``exact_quantiles``, which never gathers a column or
group into a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.operators.ordering import exact_quantiles
from churnframe.session import materialize, maybe_broadcast

SQL_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
            "float": "FLOAT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP",
            "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _is_numeric(dtype: str) -> bool:
    return dtype in ("int", "bigint", "double", "float", "smallint", "tinyint") \
        or dtype.startswith("decimal")


def null_counts(df: DataFrame, top: int | None = None, positive_only: bool = False) -> DataFrame:
    """Missing values per column (NULL; NaN counts as missing), largest first,
    ties by column name; ``top`` keeps the first n (a top-k report)."""
    exprs = []
    for name, dtype in df.dtypes:
        miss = F.col(name).isNull()
        if dtype in ("double", "float"):
            miss = miss | F.isnan(name)
        exprs.append(F.sum(miss.cast("long")).alias(name))
    wide = df.agg(*exprs)
    long = wide.unpivot([], list(df.columns), "column_name", "null_count")
    if positive_only:
        long = long.where(F.col("null_count") > 0)
    long = long.orderBy(F.desc("null_count"), F.asc("column_name"))
    return long.limit(top) if top else long


def column_info(df: DataFrame) -> DataFrame:
    """Ordinal position, non-null count and SQL type of every column."""
    wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = wide.unpivot([], list(df.columns), "column_name", "non_null_count")
    types = df.sparkSession.createDataFrame(
        [(i + 1, n, SQL_TYPE.get(t, t.upper())) for i, (n, t) in enumerate(df.dtypes)],
        "position int, column_name string, dtype string")
    return types.join(long, "column_name").select("position", "column_name",
                                                  "non_null_count", "dtype")


def dataset_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")) \
        .withColumn("n_columns", F.lit(len(df.columns)))


def _long_numeric(df: DataFrame, cols) -> DataFrame:
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
        for c in cols])).alias("_kv")
    return df.select(stack).select("_kv.column_name", "_kv.value")


EXACT = "decimal(38,18)"


def describe_numeric(df: DataFrame, cols=None) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column.

    Mean and standard deviation are order-independent: the mean comes from an
    exact decimal sum, the variance from a second pass summing the per-row
    terms (x - mean)^2 / (n - 1) exactly (non-negative terms of the size of
    the variance: no overflow, relative error of one rounding)."""
    cols = cols or [n for n, t in df.dtypes if _is_numeric(t)]
    # read by three passes (moments, deviations, quantiles): written once
    long = materialize(_long_numeric(df, cols).where(F.col("value").isNotNull()), "long_numeric")
    basic = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.col("value").cast(EXACT)).alias("_sum"),
        F.min("value").alias("min"), F.max("value").alias("max")) \
        .withColumn("mean", F.col("_sum").cast("double") / F.col("count").cast("double"))
    # one row per profiled column: a proven bound for the broadcast
    centred = long.join(F.broadcast(basic.select("column_name", "mean", "count")), "column_name")
    dev = F.col("value") - F.col("mean")
    var = centred.groupBy("column_name").agg(
        F.sum((dev * dev / (F.col("count") - 1).cast("double")).cast(EXACT)).alias("_var"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column_name"])
    qw = q.groupBy("column_name").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q25"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("q50"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q75"))
    return (basic.join(var, "column_name", "left").join(qw, "column_name", "left")
            .select("column_name", "count", "mean",
                    F.when(F.col("count") > 1, F.sqrt(F.col("_var").cast("double")))
                    .alias("std"), "min", "q25", "q50", "q75", "max"))


def describe_categorical(df: DataFrame, cols=None) -> DataFrame:
    """count (non-null), unique, top (most frequent; ties -> smallest), freq."""
    cols = cols or [n for n, t in df.dtypes if t == "string"]
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("_kv")
    counts = (df.select(stack).select("_kv.column_name", "_kv.value")
              .where(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    # Aggregations only: a window per column would put every distinct value of
    # a high-cardinality column (an id) into one task.
    summ = counts.groupBy("column_name").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        F.max("n").alias("freq"))
    # one row per profiled column: a proven bound for the broadcast
    top = (counts.join(F.broadcast(summ.select("column_name", F.col("freq").alias("n"))),
                       ["column_name", "n"])
           .groupBy("column_name").agg(F.min("value").alias("top")))
    return summ.join(top, "column_name").select("column_name", "count", "unique", "top", "freq")


def most_frequent(df: DataFrame, cols) -> DataFrame:
    """Fit of a most-frequent imputer: per column, the modal non-null value,
    ties broken by the smallest value; all steps are aggregations."""
    d = describe_categorical(df, cols)
    return d.select("column_name", F.col("top").alias("fill_value"), F.col("freq"))


def medians(df: DataFrame, cols) -> DataFrame:
    """Fit of a median imputer: exact interpolated median per column."""
    long = _long_numeric(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    return exact_quantiles(long, "value", [0.5], ["column_name"]) \
        .select("column_name", F.col("value").alias("median"))


def box_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Box-plot table per group: quartiles (linear), IQR fences, whiskers at
    the most extreme values inside the fences, outlier count."""
    # read twice (quartiles, then fences): two narrow columns written once
    data = materialize(
        df.select(F.col(group).alias("grp"), F.col(value).cast("double").alias("v"))
        .where(F.col("v").isNotNull() & ~F.isnan("v")), "box_input")
    q = exact_quantiles(data, "v", [0.25, 0.5, 0.75], ["grp"])
    qs = q.groupBy("grp").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    qs = qs.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr")) \
        .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr"))
    # one row per group; a shuffle by group would read a group in one task
    fences = maybe_broadcast(materialize(qs, "box_fences"))
    j = data.join(fences.select("grp", "lower_fence", "upper_fence"), "grp")
    inside = F.col("v").between(F.col("lower_fence"), F.col("upper_fence"))
    agg = j.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("n_outliers"))
    return fences.join(agg, "grp").select(
        F.col("grp").alias(group), "n", "q1", "median", "q3", "iqr", "lower_fence",
        "upper_fence", "whisker_low", "whisker_high", "n_outliers")


def histogram(df: DataFrame, value: str, group: str, nbins: int = 40) -> DataFrame:
    """Equal-width histogram by group: width = (max - min) / nbins from one
    min/max pass, bin = floor((x - min) / width) capped at the last bin."""
    data = df.select(F.col(value).cast("double").alias("x"), F.col(group).alias("grp")) \
        .where(F.col("x").isNotNull())
    lo, hi = data.agg(F.min("x"), F.max("x")).first()       # two scalars
    if lo is None:
        return data.select(F.lit(0).alias("bin"), F.col("grp").alias(group),
                           F.lit(None).cast("double").alias("bin_start"),
                           F.lit(None).cast("double").alias("bin_end"),
                           F.lit(0).cast("long").alias("n")).limit(0)
    j = data.withColumn("lo", F.lit(float(lo))).withColumn(
        "width", (F.lit(float(hi)) - F.lit(float(lo))) / F.lit(float(nbins)))
    b = F.when(F.col("width") > 0,
               F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")),
                       F.lit(nbins - 1))).otherwise(F.lit(0)).cast("int")
    return (j.withColumn("bin", b)
            .groupBy("bin", "grp", "lo", "width").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", F.col("grp").alias(group),
                    (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
                    (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
                    "n"))


def rounded_width(lo: float, hi: float, nbins: int) -> tuple[int, int]:
    """(m, k): m * 10^k with m of 1, 2, 5 is the smallest such width whose
    multiples cut [lo, hi] into at most ``nbins`` bins (two at least, as zero is
    always a limit); one value gives (1, 0)."""
    nbins = max(nbins, 2)
    if not hi > lo or not math.isfinite(hi - lo):
        return 1, 0
    # 10^308 is the largest power of ten
    k = max(math.floor(math.log10(max((hi - lo) / nbins, 5e-324))) - 1, -308)
    while True:
        for m in (1, 2, 5):
            if _multiple(hi, m, k) - _multiple(lo, m, k) < nbins:
                return m, k
        k += 1


def _multiple(x: float, m: int, k: int) -> int:
    # powers of ten are exact, their inverses are not
    return math.floor(x / (m * 10.0 ** k)) if k >= 0 else math.floor(x * 10.0 ** -k / m)


def rounded_histogram(df: DataFrame, value: str, group: str, nbins: int = 40) -> DataFrame:
    """Histogram by group with limits at multiples of a rounded width, at most
    ``nbins`` bins: one min/max pass, then one pre-aggregated count.  Missing,
    NaN and infinite values are left out; an empty column gives no rows."""
    x = F.col(value).cast("double")
    data = df.select(x.alias("x"), F.col(group).alias("grp")).where(
        x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    lo, hi = data.agg(F.min("x"), F.max("x")).first()       # two scalars
    m, k = rounded_width(lo, hi, nbins) if lo is not None else (1, 0)
    first = _multiple(lo, m, k) if lo is not None else 0
    if k >= 0:
        at, edge = F.floor(F.col("x") / F.lit(m * 10.0 ** k)), lambda b: b * F.lit(m * 10.0 ** k)
    else:
        at, edge = F.floor(F.col("x") * F.lit(10.0 ** -k) / F.lit(float(m))), lambda b: b * F.lit(float(m)) / F.lit(10.0 ** -k)
    return (data.withColumn("at", at.cast("long")).groupBy("at", "grp").agg(F.count(F.lit(1)).alias("n"))
            .select((F.col("at") - first).cast("int").alias("bin"), F.col("grp").alias(group),
                    edge(F.col("at").cast("double")).alias("bin_start"),
                    edge((F.col("at") + 1).cast("double")).alias("bin_end"), "n"))
