"""Star-schema load: staging, dimensions, fact, merges and data-quality checks.

Surrogate keys are *ingest positions*: a dimension row's key is the
``row_id`` of the first raw row that carried its natural key, a fact row's
key is its own ``row_id``.  Keys therefore follow insertion order (what an
auto-increment key gives), are stable across reruns of the same batch, and
cost no global sort.  ``dense_keys`` renumbers a dimension 1..n in the same
order when dense keys are required.

Plan shape at scale: the customer dimension is a partial (map-side)
aggregation on ``customer_id`` followed by a shuffle join with the staging
rows (AQE splits a hot customer); contract and service dimensions come from
one small pre-aggregate written to the shared checkpoint folder, so the
planner knows their real size and broadcasts them only when it is under
``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.functions.coerce import clean_total_charges, int_default, safe_double
from churnframe.operators.ordering import dense_index
from churnframe.schema import (CONTRACT_COLS, CUSTOMER_ATTRS, DIM_CONTRACT_SCHEMA,
                               DIM_CUSTOMER_SCHEMA, DIM_SERVICES_SCHEMA, FACT_SCHEMA,
                               HEADER_TO_COLUMN, MEASURE_COLS, REQUIRED_HEADERS, SERVICE_COLS,
                               SNAPSHOT_DATE)
from churnframe.session import materialize, release
from churnframe.sources.raw import require_columns
from churnframe.sources.snapshots import TableGroup


class Star(NamedTuple):
    dim_customer: DataFrame
    dim_contract: DataFrame
    dim_services: DataFrame
    fact: DataFrame


FACT_COLUMNS = FACT_SCHEMA.fieldNames()


def stage(raw: DataFrame, snapshot_date: str = SNAPSHOT_DATE) -> DataFrame:
    """Contract check, rename from one header map, coerce, stamp the snapshot."""
    require_columns(raw, ["row_id"] + REQUIRED_HEADERS)
    r = raw.select("row_id", *REQUIRED_HEADERS).withColumnsRenamed(HEADER_TO_COLUMN)
    text = ["customer_id", "gender", "partner", "dependents", "country", "state"] \
        + CONTRACT_COLS + SERVICE_COLS
    coerced = {
        "senior_citizen": int_default("senior_citizen"),
        "tenure_months": int_default("tenure_months"),
        "monthly_charges": safe_double("monthly_charges"),
        "total_charges": clean_total_charges("total_charges"),
        "cltv": safe_double("cltv"),
    }
    out = [F.col("row_id").cast("long").alias("row_id")]
    for name in HEADER_TO_COLUMN.values():
        if name in coerced:
            out.append(coerced[name].alias(name))
        elif name in text or name == "churn_label":
            out.append(F.col(name).cast("string").alias(name))
    out.append(F.lit(snapshot_date).alias("snapshot_date"))
    return r.select(*out)


def build_dim_customer(staging: DataFrame) -> DataFrame:
    """First row per ``customer_id`` wins (insert-or-ignore).  Rows with a NULL
    id are kept as distinct tuples (a UNIQUE column admits many NULLs) and
    never match a fact row."""
    # first by all text columns with a number as the only buffer, which Spark
    # aggregates by hash; a least struct over all rows would be sorted
    row_id = F.when(F.count("row_id") == F.count(F.lit(1)), F.min("row_id")).alias("row_id")
    firsts = (staging.where(F.col("customer_id").isNotNull())
              .groupBy("customer_id", *CUSTOMER_ATTRS).agg(row_id)
              .groupBy("customer_id")
              .agg(F.min(F.struct("row_id", *CUSTOMER_ATTRS)).alias("_first"))
              .select(F.col("_first.row_id").alias("customer_key"), "customer_id",
                      *[F.col(f"_first.{c}").alias(c) for c in CUSTOMER_ATTRS]))
    nulls = (staging.where(F.col("customer_id").isNull())
             .groupBy("customer_id", *CUSTOMER_ATTRS)
             .agg(F.min("row_id").alias("customer_key")))
    return firsts.unionByName(nulls)


def _distinct_dim(staging: DataFrame, cols, key: str) -> DataFrame:
    # group-by treats NULL as a value, like drop_duplicates
    return staging.groupBy(*cols).agg(F.min("row_id").alias(key)).select(key, *cols)


def build_dim_contract(staging: DataFrame) -> DataFrame:
    return _distinct_dim(staging, CONTRACT_COLS, "contract_key")


def build_dim_services(staging: DataFrame) -> DataFrame:
    return _distinct_dim(staging, SERVICE_COLS, "services_key")


def _null_safe_cond(left: DataFrame, right: DataFrame, cols):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def new_rows(existing: DataFrame, incoming: DataFrame, natural_key, key: str) -> DataFrame:
    """Incoming rows whose natural key is absent from ``existing``, with keys
    that continue after the existing maximum, in ingest order.  A single-column
    key is compared by plain equality, so rows with a NULL id are all new (a
    NULL never equals another); composite keys are compared null-safe."""
    natural_key = list(natural_key)
    known = existing.select(*natural_key)
    same = (incoming[natural_key[0]] == known[natural_key[0]] if len(natural_key) == 1
            else _null_safe_cond(incoming, known, natural_key))
    new = incoming.join(known, same, "left_anti")
    base = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("_base")).first()["_base"]
    return new.withColumn(key, F.col(key) + F.lit(int(base)))


def merge_dimension(existing: DataFrame, incoming: DataFrame, natural_key, key: str) -> DataFrame:
    """``existing`` plus its ``new_rows``; existing rows are never updated.
    Rerunning a batch without NULL ids is a no-op."""
    return existing.unionByName(new_rows(existing, incoming, natural_key, key))


def build_fact(staging: DataFrame, dim_customer: DataFrame, dim_contract: DataFrame,
               dim_services: DataFrame) -> DataFrame:
    """Resolve surrogate keys with inner equi-joins; a NULL or unknown natural
    key drops the row (see ``fact_dropped_rows``).  Join strategies are left to
    the planner/AQE, which broadcast the dimensions when their measured size
    allows."""
    cust = dim_customer.where(F.col("customer_id").isNotNull()) \
        .select("customer_id", "customer_key")
    # the small dimensions first: their twelve text columns become two numbers
    # before the rows are shuffled to their customers
    j = staging.join(dim_contract, CONTRACT_COLS, "inner")
    j = j.join(dim_services, SERVICE_COLS, "inner").drop(*CONTRACT_COLS, *SERVICE_COLS)
    j = j.join(cust, "customer_id", "inner")
    return j.select(F.col("row_id").alias("snapshot_id"), "customer_key", "contract_key",
                    "services_key", *MEASURE_COLS, "churn_label", "snapshot_date")


def small_dimensions(staging: DataFrame, materialize_result: bool = True):
    """Contract and service dimensions from ONE pass over staging.

    The pass groups by the 12 natural-key columns together (partial
    aggregation, so the shuffle carries at most one row per combination and
    map task); both dimensions are then re-aggregations of that small
    result, because the min of per-combination minima is the overall
    minimum.  The combination table is written once to the shared checkpoint
    folder: lineage is cut and the planner sees its true size."""
    combo = staging.groupBy(*CONTRACT_COLS, *SERVICE_COLS).agg(
        F.min("row_id").alias("_first"))
    if materialize_result:
        combo = materialize(combo, "dim_combo")
    dk = combo.groupBy(*CONTRACT_COLS).agg(F.min("_first").alias("contract_key")) \
        .select("contract_key", *CONTRACT_COLS)
    ds = combo.groupBy(*SERVICE_COLS).agg(F.min("_first").alias("services_key")) \
        .select("services_key", *SERVICE_COLS)
    return dk, ds


def load_star(staging: DataFrame, materialize_result: bool = True) -> Star:
    dc = build_dim_customer(staging)
    dk, ds = small_dimensions(staging, materialize_result)
    return Star(dc, dk, ds, build_fact(staging, dc, dk, ds))


def merge_star(existing: Star, staging: DataFrame) -> Star:
    """Load a new batch into an existing star: dims merge by natural key (no
    duplicates on rerun), the fact is overwritten from the new batch."""
    dc = merge_dimension(existing.dim_customer, build_dim_customer(staging),
                         ["customer_id"], "customer_key")
    dk = merge_dimension(existing.dim_contract, build_dim_contract(staging),
                         CONTRACT_COLS, "contract_key")
    ds = merge_dimension(existing.dim_services, build_dim_services(staging),
                         SERVICE_COLS, "services_key")
    return Star(dc, dk, ds, build_fact(staging, dc, dk, ds))


def fact_dropped_rows(staging: DataFrame, star: Star) -> DataFrame:
    """Staging rows that did not reach the fact, with the reason."""
    dropped = staging.join(star.fact.select(F.col("snapshot_id").alias("row_id")),
                           "row_id", "left_anti")
    nk = F.col("customer_id").isNull()
    nc = F.lit(False)
    for c in CONTRACT_COLS:
        nc = nc | F.col(c).isNull()
    ns = F.lit(False)
    for c in SERVICE_COLS:
        ns = ns | F.col(c).isNull()
    reason = (F.when(nk, "null customer_id").when(nc, "null contract key")
              .when(ns, "null services key").otherwise("unmatched key"))
    return dropped.select("row_id", "customer_id", reason.alias("reason"))


def dense_keys(dim: DataFrame, key: str) -> DataFrame:
    """Renumber a dimension 1..n in key (= ingest) order, in parallel."""
    return dense_index(dim, key, name="dense_key")


def stored_star(spark, path: str) -> TableGroup:
    """The four tables under ``path``, whose versions switch together."""
    return TableGroup(spark, path, {"dim_customer": DIM_CUSTOMER_SCHEMA, "dim_contract": DIM_CONTRACT_SCHEMA,
                                    "dim_services": DIM_SERVICES_SCHEMA, "fact_customer_snapshot": FACT_SCHEMA},
                      {"fact_customer_snapshot": "snapshot_date"})


def read_star(spark, path: str, version: int | None = None) -> Star:
    """A stored star, as its last load (or the given one) left it."""
    return Star(**{"fact" if t == "fact_customer_snapshot" else t: df
                   for t, df in stored_star(spark, path).read_all(version).items()})


def _write_fact(group: TableGroup, staging: DataFrame, dims: list) -> dict:
    return group.write("fact_customer_snapshot", build_fact(staging, *[group.frame(t, f) for t, f in dims]))


def load_and_write(staging: DataFrame, path: str) -> Star:
    """Warehouse order: write the dimensions, then resolve the fact's keys
    against the stored dimensions (each dimension is aggregated once), write
    the fact by ``snapshot_date``, publish the four tables as one version and
    return the stored star.

    Plain Parquet, not buckets: a join on a hot customer then goes through a
    shuffle, which AQE can split."""
    group = stored_star(staging.sparkSession, path)
    before, _ = group.manifest()
    dk, ds = small_dimensions(staging)
    tables = {t: group.write(t, df) for t, df in (
        ("dim_customer", build_dim_customer(staging)), ("dim_contract", dk), ("dim_services", ds))}
    tables["fact_customer_snapshot"] = _write_fact(group, staging, list(tables.items()))
    return read_star(staging.sparkSession, path, group.publish(before, tables))


def merge_and_write(path: str, staging: DataFrame) -> Star:
    """Load a new batch into a stored star: unknown natural keys are added to
    the dimensions (stored rows are never rewritten), and the fact's partitions
    of the batch's snapshot dates are replaced, all in one new version."""
    group = stored_star(staging.sparkSession, path)
    before, tables = group.manifest()
    parts = (("dim_customer", build_dim_customer, ["customer_id"], "customer_key"),
             ("dim_contract", build_dim_contract, CONTRACT_COLS, "contract_key"),
             ("dim_services", build_dim_services, SERVICE_COLS, "services_key"))
    for table, build, natural, key in parts:
        existing = group.frame(table, tables[table])
        new = materialize(new_rows(existing, build(staging), natural, key).select(*existing.columns), table)
        if not new.isEmpty():
            tables[table] = tables[table] + group.write(table, new)
        release(new)
    fact = _write_fact(group, staging, [(t, tables[t]) for t, *_ in parts])
    tables["fact_customer_snapshot"] = tables["fact_customer_snapshot"] | fact
    return read_star(staging.sparkSession, path, group.publish(before, tables))


def load_report(star: Star) -> DataFrame:
    """Row count per table as (table_name, row_count)."""
    parts = [star.dim_customer.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit("dim_customer").alias("table_name"), "row_count"),
             star.dim_contract.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit("dim_contract").alias("table_name"), "row_count"),
             star.dim_services.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit("dim_services").alias("table_name"), "row_count"),
             star.fact.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit("fact_customer_snapshot").alias("table_name"), "row_count")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_duplicate_keys(star: Star) -> DataFrame:
    """Natural keys that occur more than once in a dimension."""
    def dups(df, name, cols):
        return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
                .where(F.col("n_rows") > 1)
                .select(F.lit(name).alias("table_name"),
                        F.concat_ws("|", *cols).alias("natural_key"), "n_rows"))
    return (dups(star.dim_customer.where(F.col("customer_id").isNotNull()),
                 "dim_customer", ["customer_id"])
            .unionByName(dups(star.dim_contract, "dim_contract", CONTRACT_COLS))
            .unionByName(dups(star.dim_services, "dim_services", SERVICE_COLS)))


def dq_orphans(star: Star) -> DataFrame:
    """Fact rows whose foreign key has no dimension row, per foreign key."""
    def orphans(key, dim):
        bad = star.fact.join(dim.select(key), key, "left_anti")
        return bad.agg(F.count(F.lit(1)).alias("orphan_rows")) \
            .select(F.lit(key).alias("foreign_key"), "orphan_rows")
    return (orphans("customer_key", star.dim_customer)
            .unionByName(orphans("contract_key", star.dim_contract))
            .unionByName(orphans("services_key", star.dim_services)))
