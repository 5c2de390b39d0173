"""The flat training view over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.operators.star import Star
from churnframe.schema import (CONTRACT_COLS, CUSTOMER_ATTRS, MEASURE_COLS, SERVICE_COLS,
                               VIEW_COLUMNS)

ALL_DIMS = ("customer", "contract", "services")


def training_view(star: Star, dims=ALL_DIMS, keep_snapshot_id: bool = False) -> DataFrame:
    """fact JOIN dim_customer JOIN dim_contract JOIN dim_services on surrogate
    keys, 25 columns in the reference order, ``churn_target`` = label 'Yes' -> 1
    (NULL -> 0).

    ``dims`` builds a slimmer view for queries that need fewer dimensions:
    every fact row produced by ``build_fact`` has all three keys (checked by
    ``dq_orphans``), so dropping an unused inner join leaves the rows unchanged
    while skipping its shuffle.  Columns of omitted dimensions are absent."""
    v = star.fact
    cols = ["customer_id"] + CUSTOMER_ATTRS if "customer" in dims else []
    if "customer" in dims:
        # as large as the fact: shuffle join (AQE handles skew)
        v = v.join(star.dim_customer.select("customer_key", "customer_id", *CUSTOMER_ATTRS),
                   "customer_key", "inner")
    def small_join(left, dim, key):
        # the planner broadcasts the dimension when its measured size allows
        return left.join(dim, key, "inner")

    if "contract" in dims:
        v = small_join(v, star.dim_contract, "contract_key")
        cols += CONTRACT_COLS
    if "services" in dims:
        v = small_join(v, star.dim_services, "services_key")
        cols += SERVICE_COLS
    target = F.when(F.col("churn_label") == "Yes", 1).otherwise(0).alias("churn_target")
    out = [F.col(c) for c in cols] + [F.col(c) for c in MEASURE_COLS] + [target,
                                                                          F.col("snapshot_date")]
    if keep_snapshot_id:
        out.append(F.col("snapshot_id"))
    res = v.select(*out)
    if set(dims) == set(ALL_DIMS):
        order = VIEW_COLUMNS + (["snapshot_id"] if keep_snapshot_id else [])
        res = res.select(*order)
    return res


def register_view(star: Star, name: str = "vw_churn_training_dataset") -> DataFrame:
    v = training_view(star)
    v.createOrReplaceTempView(name)
    return v
