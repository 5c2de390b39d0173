"""Training rows of a large table lie in parts of equal size."""

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from churnframe.ml import pipeline as MP


class AsItIs:
    @staticmethod
    def transform(df):
        return df


def test_training_rows_are_dealt_out(spark, monkeypatch):
    uneven = spark.range(0, 4000, 1, 1).union(spark.range(4000, 4100, 1, 2)).select(
        (F.col("id") % 2).cast("double").alias("label"), array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))

    def parts(df):
        return [r["count"] for r in df.groupBy(F.input_file_name()).count().collect()]
    monkeypatch.setattr(MP, "SPREAD_ROWS", 4000, raising=False)
    many = MP.prepared(AsItIs, uneven)
    assert max(parts(many)) < 1.5 * min(parts(many)) and many.count() == 4100
    assert many.select(F.col("features").cast("string")).distinct().count() == 4100
    few = MP.prepared(AsItIs, uneven.filter("label = 0"))
    assert max(parts(few)) == 2000
