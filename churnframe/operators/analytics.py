"""Attrition and revenue analytics over the training view.

All are single group-bys with partial aggregation: the shuffle carries one
row per (map task, group), so a group holding a third of the rows costs the
same as any other.  Shares use a window over the already-aggregated rows,
never over raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnframe.functions.bands import tenure_band_cut, tenure_band_sql
from churnframe.functions.features import addon_count
from churnframe.schema import TARGET, TENURE_BAND_LABELS


def churn_rate_by(view: DataFrame, key: str, target: str = TARGET,
                  order: str = "rate_desc") -> DataFrame:
    """ROUND(100 * AVG(target), 2) AS churn_rate_pct, COUNT(*) AS customers."""
    out = view.groupBy(key).agg(
        F.round(F.lit(100.0) * F.avg(target), 2).alias("churn_rate_pct"),
        F.count(F.lit(1)).alias("customers"))
    if order == "rate_desc":
        return out.orderBy(F.desc("churn_rate_pct"), F.asc(key))
    return out.orderBy(F.asc_nulls_first(key))


def churn_by_contract(view: DataFrame) -> DataFrame:
    return churn_rate_by(view, "contract_type")


def churn_by_internet_service(view: DataFrame) -> DataFrame:
    return churn_rate_by(view, "internet_service")


def churn_by_tenure_band(view: DataFrame, tenure: str = "tenure_months") -> DataFrame:
    return churn_rate_by(view.withColumn("tenure_band", tenure_band_sql(tenure)),
                         "tenure_band", order="key")


def churn_by_addon_count(view: DataFrame) -> DataFrame:
    return churn_rate_by(view.select(addon_count(view.columns).alias("addon_count"), TARGET),
                         "addon_count", order="key")


def revenue_at_risk(view: DataFrame, measure: str = "monthly_charges") -> DataFrame:
    return view.groupBy(TARGET).agg(
        F.round(F.sum(measure), 2).alias("total_monthly_charges"),
        F.round(F.avg(measure), 2).alias("avg_monthly_charges"),
        F.count(F.lit(1)).alias("customers"))


def churn_mean_by_band(view: DataFrame, complete: bool = True,
                       tenure: str = "tenure_months") -> DataFrame:
    """Unrounded mean target per categorical cut band; NULL bands drop.  With
    ``complete`` every band of the domain appears (empty ones with NULL mean)."""
    banded = view.select(tenure_band_cut(tenure, fill_null=False, out_of_range=None)
                         .alias("tenure_band"), TARGET)
    means = (banded.where(F.col("tenure_band").isNotNull())
             .groupBy("tenure_band").agg(F.avg(TARGET).alias("churn_mean"),
                                         F.count(F.lit(1)).alias("customers")))
    if not complete:
        return means
    spark = view.sparkSession
    domain = spark.createDataFrame([(b,) for b in TENURE_BAND_LABELS], "tenure_band string")
    return (domain.join(means, "tenure_band", "left")
            .select("tenure_band", "churn_mean",
                    F.coalesce("customers", F.lit(0)).alias("customers")))


def label_share_by(view: DataFrame, key: str = "contract_type",
                   label: str = TARGET) -> DataFrame:
    """value_counts(normalize=True) within each key group; NULLs excluded."""
    counts = (view.where(F.col(key).isNotNull() & F.col(label).isNotNull())
              .groupBy(key, label).agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(key)
    return counts.select(key, label, "n",
                         (F.col("n") / F.sum("n").over(w)).alias("rate"))


def target_share(view: DataFrame, label: str = TARGET) -> DataFrame:
    counts = view.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one row per label value: a window over the aggregated rows is bounded
    return counts.select(label, "n", (F.col("n") / F.sum("n").over(Window.partitionBy()))
                         .alias("share"))


def target_counts(view: DataFrame, label: str = TARGET) -> DataFrame:
    return (view.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(label)))
