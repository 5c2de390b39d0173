"""Running monitoring summary as a stateful streaming aggregation.

Log files are read as a stream; a group-by on the flag keeps one state row per
flag (count and probability sum) in the state store, so state stays tiny no
matter how long the log grows.  Each micro-batch's complete result replaces
the published summary table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnframe.schema import PREDICTION_LOG_SCHEMA


def running_summary(log_stream: DataFrame) -> DataFrame:
    """Count and probability sum per flag.  The sum is kept as an exact
    decimal, so the published average does not depend on how rows were
    split into micro-batches."""
    return log_stream.groupBy("churn_flag").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.col("churn_probability").cast("decimal(38,18)")).alias("_prob_sum"))


def start_summary(spark: SparkSession, log_path: str, summary_path: str, checkpoint: str,
                  max_files: int = 1, available_now: bool = True):
    stream = (spark.readStream.schema(PREDICTION_LOG_SCHEMA)
              .option("maxFilesPerTrigger", max_files).parquet(log_path))

    def publish(batch: DataFrame, batch_id: int) -> None:
        (batch.select("churn_flag",
                      (F.col("_prob_sum").cast("double") / F.col("count").cast("double"))
                      .alias("avg_probability"), "count")
         .write.mode("overwrite").parquet(summary_path))

    writer = (running_summary(stream).writeStream.outputMode("complete")
              .foreachBatch(publish).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="10 seconds")
    return writer.start()
