"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnframe.session import BROADCAST_ROWS, ensure_checkpoint_dir, materialize, maybe_broadcast, ship_package


def prepare(spark: SparkSession) -> None:
    """Shared folder set and this package importable in Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize_as(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write once into the shared folder and read back (cuts lineage)."""
    return materialize(df, name, options)


def bounded_sample(df: DataFrame, group: str, rank_by: str, per_group: int) -> DataFrame:
    """At most ``per_group`` rows of each value of ``group``, those with the
    smallest ``rank_by`` (a 64-bit hash).  The rows are first thinned by a
    threshold on the hash that leaves about three times as many as wanted, so
    the ranking sorts a bounded number of rows however large the group is.
    ``group`` has few values (languages, grades); their counts are collected."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()
    keep = F.lit(False)
    for r in counts:
        share = min(1.0, 3.0 * per_group / r["n"])
        top = (1 << 63) - 1 if share == 1.0 else int((2 * share - 1) * ((1 << 63) - 1))
        keep = keep | (F.col(group).eqNullSafe(F.lit(r[group])) & (F.col(rank_by) <= F.lit(top)))
    rank, = fresh(df, ["rank"])
    order = Window.partitionBy(group).orderBy(rank_by, *[c for c in df.columns if c not in (group, rank_by)])
    return (df.filter(keep).withColumn(rank, F.row_number().over(order))
              .filter(F.col(rank) <= per_group).drop(rank))


def fresh(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Names for helper columns that clash with none of ``df``'s columns
    (compared without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
