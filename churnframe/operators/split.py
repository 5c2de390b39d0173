"""Stratified train/test split and balanced class weights."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnframe.operators.ordering import cumulative_sums


def stratified_quotas(class_counts: dict, test_size: float = 0.2) -> dict:
    """Training rows per class: n_test = ceil(test_size * n); the n - n_test
    training rows are allocated by largest remainder (ties -> smaller class
    value); each class's test share is the rest."""
    n = sum(class_counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    cont = {k: n_train * v / n for k, v in class_counts.items()}
    quota = {k: math.floor(c) for k, c in cont.items()}
    left = n_train - sum(quota.values())
    for k in sorted(cont, key=lambda k: (-(cont[k] - quota[k]), k))[:left]:
        quota[k] += 1
    return quota


def stratified_split(df: DataFrame, label: str, row_id: str, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``split`` ('train'/'test').  Inside each class rows are ordered by
    the first 13 hex digits of ``md5('seed:row_id')`` (ties by row id) and the
    first quota rows train.

    Only a narrow (label, hash, row id) table is ranked -- in parallel by
    ``cumulative_sums``, no class gathered into one task -- to find each
    class's cut-off (hash, row id); the split is then a per-row predicate on
    the original rows (one cut-off per class reaches the driver), so wide rows
    are neither shuffled nor copied.  Deterministic for a given seed."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}   # one row per class
    quota = stratified_quotas(counts, test_size)
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string"))), 1, 13)
    h = F.conv(digits, 16, 10).cast("long")
    narrow = df.select(label, row_id, h.alias("_h")).withColumn("_one", F.lit(1).cast("long"))
    ranked = cumulative_sums(narrow, "_h", ["_one"], [label], prefix="_rank",
                             tie_cols=[row_id])
    wanted = F.lit(False)
    for k, v in quota.items():
        wanted = wanted | ((F.col(label) == F.lit(k)) & (F.col("_rank_one") == F.lit(v)))
    cuts = {r[label]: (r["_h"], r[row_id]) for r in ranked.where(wanted).collect()}
    train = F.lit(False)
    for k, (hk, rk) in cuts.items():
        below = (F.col("_h") < F.lit(hk)) | ((F.col("_h") == F.lit(hk)) & (F.col(row_id) <= F.lit(rk)))
        train = train | ((F.col(label) == F.lit(k)) & below)
    return df.withColumn("_h", h).withColumn(
        "split", F.when(train, "train").otherwise("test")).drop("_h")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class (k = number of classes)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    # one row per class: windows over the aggregated rows are bounded
    everything = Window.partitionBy()
    n = F.sum("n_c").over(everything)
    k = F.count(F.lit(1)).over(everything)
    return counts.select(label, "n_c", (n.cast("double") / (k * F.col("n_c")).cast("double"))
                         .alias("weight"))


def with_class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    # one row per class: a proven bound for a broadcast
    return df.join(F.broadcast(w), label)
