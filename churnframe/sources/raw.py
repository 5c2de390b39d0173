"""Raw extract scan (A1) with the input guard (A2) and column contract (A3)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnframe.schema import REQUIRED_HEADERS


def require_columns(df: DataFrame, required=REQUIRED_HEADERS) -> DataFrame:
    """Fail before any work, listing every missing column."""
    require_columns_named(df.columns, required)
    return df


CORRUPT = "_corrupt_record"


def _scan(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The extract as stored, every CSV column a string, with the text of CSV
    records whose number of fields differs from the header in ``CORRUPT``."""
    try:
        if fmt != "csv":
            return spark.read.format(fmt).load(path)
        # whole records are parsed, else their number of fields is not checked
        reader = (spark.read.option("header", True).option("columnPruning", False).option("ignoreLeadingWhiteSpace", False)
                  .option("ignoreTrailingWhiteSpace", False))
        header = reader.csv(path).columns  # reads the header only
        require_columns_named(header)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
        return (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                .schema(schema).csv(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"raw extract not found: {path}") from exc
        raise


def require_columns_named(present, required=REQUIRED_HEADERS) -> None:
    missing = [c for c in required if c not in set(present)]
    if missing:
        raise ValueError(f"Missing expected columns: {missing}")


def _parsed():
    """Always true; names a parsed column, since a scan that needs nothing but
    the corrupt record is not allowed."""
    return F.length(F.coalesce(F.col(f"`{REQUIRED_HEADERS[0]}`"), F.lit(""))) >= 0


def read_raw(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a landed extract: any column order, extra columns ignored, all
    missing columns reported together, every value a string.  Ragged CSV
    records are left out here and listed by ``ragged_records``.

    Without a ``row_id`` column rows are numbered by their place in the scan
    (file by file, in file order; increasing, not dense)."""
    df = _scan(spark, path, fmt)
    require_columns(df)
    if CORRUPT in df.columns:
        df = df.where(F.col(f"`{CORRUPT}`").isNull() & _parsed())
    row_id = (F.col("row_id").cast("long") if "row_id" in df.columns
              else F.monotonically_increasing_id())
    return df.select(row_id.alias("row_id"), *[F.col(f"`{h}`").cast("string").alias(h) for h in REQUIRED_HEADERS])


def ragged_records(spark: SparkSession, path: str) -> DataFrame:
    """CSV records with more or fewer fields than the header, as one text."""
    df = _scan(spark, path, "csv")
    return df.where(F.col(f"`{CORRUPT}`").isNotNull() & _parsed()).select(F.col(f"`{CORRUPT}`").alias("record"))


def write_csv_extract(raw: DataFrame, path: str) -> None:
    """Land an extract as CSV with a header; every value quoted so blank and
    whitespace-only cells survive the round trip (NULL stays an empty field)."""
    (raw.write.mode("overwrite").option("header", True).option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
