"""Spark session and shared-storage helpers.

Every job runs with the session time zone pinned to UTC, AQE on (coalescing,
skew-join splitting) and the UI off.  Lineage is cut only with tables written
to the folder named by ``spark.checkpoint.dir`` (``materialize``); a private
temporary folder is created only for a local-mode session where the
setting is absent (tests, bench).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.functions import broadcast

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep small shuffles spread over the cores instead of coalescing them
    # into one task; large shuffles are sized by the advisory size as usual
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # broadcast only genuinely small relations (dimension tables, per-group
    # statistics); anything larger is joined by shuffle so the work spreads
    "spark.sql.autoBroadcastJoinThreshold": "1m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "churnframe",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring it only when unset."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return configured or current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder "
            "(HDFS/S3/ABFS) that every executor can reach")
    folder = tempfile.mkdtemp(prefix="churnframe-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables/models."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/churnframe/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1)


def materialize(df, name: str = "table", options: dict | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back.  This cuts lineage (a lost executor re-reads files instead of
    recomputing upstream stages) and gives the planner exact file sizes, so
    its size-based broadcast decision applies to the result.  ``options`` go
    to the writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    out = spark.read.parquet(path)
    out._scratch_path = path
    return out


#: a relation is broadcast only when it has been written and counted, and has
#: at most this many rows; beyond it the join shuffles
BROADCAST_ROWS = 200_000


def maybe_broadcast(df, limit: int = BROADCAST_ROWS):
    """Broadcast hint for a written table whose row count has been checked."""
    return broadcast(df) if df.limit(limit + 1).count() <= limit else df


def release(*frames) -> None:
    """Delete the files behind frames returned by ``materialize`` that nothing
    will read again; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path is None:
            continue
        jvm, jsc = df.sparkSession._jvm, df.sparkSession._jsc
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(jsc.hadoopConfiguration()).delete(folder, True)
        df._scratch_path = None


def free_shuffles(spark) -> None:
    """Let the cleaner remove the shuffle files of finished steps now.  It acts
    when the driver collects its garbage, which Spark otherwise leaves to a
    timer (``spark.cleaner.periodicGC.interval``)."""
    gc.collect()
    spark._jvm.System.gc()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (pandas UDFs,
    mapInPandas) by shipping it as a zip with ``addPyFile`` once per app."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    # the driver serves the zip to the executors, so its own folder will do
    out_dir = tempfile.mkdtemp(prefix="churnframe-pkg-")
    zpath = os.path.join(out_dir, "churnframe.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("churnframe",
                                               os.path.relpath(full, pkg_dir)))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)
