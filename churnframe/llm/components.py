"""Connected components of an undirected edge table, as Spark joins.

Alternating large-star and small-star steps turn any graph into stars around
each component's smallest node in a logarithmic number of rounds.  Every step
is a minimum per node (pre-aggregated before the shuffle) joined back to the
edges, so no neighbour list is ever gathered in one task.  Each round is
written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.llm.common import materialize_as
from churnframe.session import release


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.filter("v > u").join(low, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(low.select("u", F.col("m").alias("v")))
                  .filter("u <> v").distinct())


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(u, v) edges, self loops and repeats allowed -> (node, component) for
    every node with a real edge; the component is its smallest node."""
    e = materialize_as(edges.select("u", "v").filter("u <> v").distinct(), "cc-edges")
    mark = None
    for _ in range(max_rounds):
        last, e = e, materialize_as(_small_star(_large_star(e)), "cc-round")
        release(last)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    centres = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(centres)
