"""Safe type coercion expressions (JVM-side, no UDFs).

Spark's string->double cast accepts forms such as ``'1d'`` and ``'nan'`` that a
strict numeric parser rejects, so every coercion is guarded by an explicit
decimal/scientific pattern applied after trimming.  NaN and +/-inf never leave
these functions: they become NULL (missing), as in the reference's pandas code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

WHITE_SPACE = " \t\n\x0b\f\r"  # what \s matches


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c) -> Column:
    """NaN, +inf and -inf -> NULL."""
    c = _col(c)
    return F.when(F.isnan(c) | c.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(c)


def safe_double(c) -> Column:
    """Unparsable/blank/NULL -> NULL, else the double value."""
    s = F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))
    # the pattern admits no NaN; an overflow is infinite.  Written so that each
    # step is computed once (``finite_or_null`` names its argument three times)
    parsed = F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))
    return F.nullif(F.nullif(parsed, F.lit(float("inf"))), F.lit(float("-inf")))


def int_default(c, default: int = 0) -> Column:
    """Coerce, fill missing with ``default`` and truncate to int."""
    d = F.coalesce(safe_double(c), F.lit(float(default)))
    return F.coalesce(d.try_cast("int"), F.lit(default)).cast("int")


def blank_to_null(c) -> Column:
    """NULL or whitespace-only strings -> NULL."""
    c = _col(c)
    return F.when(c.isNull() | c.cast("string").rlike(r"^\s*$"), F.lit(None)).otherwise(c)


def clean_total_charges(c) -> Column:
    """Blank -> NULL, else safe numeric coercion (B7); native, no per-row UDF."""
    return safe_double(blank_to_null(c))
