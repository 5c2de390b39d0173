"""Readers for the supplied parquet tables.

Reads are memoised per (Spark application, folder, table): a DataFrame is only
a plan, so reusing it re-reads the files on every action but skips the
footer/listing work of ``spark.read.parquet`` each time a query is built."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

_READS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    df = _READS.get(key)
    if df is None:
        df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
        _READS[key] = df
    return df.select(*columns) if columns else df
