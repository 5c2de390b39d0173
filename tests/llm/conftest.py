import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]

#: a null, an empty and a blank text, a repeated row, one very long text
EDGE = [(1, None, "en", "s"), (2, "", None, "s"), (3, " \n\t ", "en", None), (4, "one two three", "en", "s"),
        (4, "one two three", "en", "s"), (None, "a row without an id but with some words in it", "en", "s"),
        (5, " ".join(f"w{i}" for i in range(30000)), "en", "s")]


@pytest.fixture(scope="session")
def edge(spark):
    """Rows with nulls, empty and long texts, repeats, and clashing columns."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, source string")
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumn("w", F.lit("x")).withColumn(
        "kept", F.lit("y")).withColumn("coded", F.lit(1)).withColumn("k1", F.lit(2))


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
