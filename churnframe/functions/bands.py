"""Tenure banding: the SQL flavour (B9) and the interval-cut flavour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnframe.schema import (TENURE_BAND_LABELS, TENURE_CUT_EDGES, TENURE_SQL_BANDS,
                               TENURE_SQL_OTHER)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tenure_band_sql(c="tenure_months") -> Column:
    """BETWEEN on inclusive integer ranges; everything else (NULL, negatives,
    fractions between ranges, large values) falls to the last label."""
    t = _col(c)
    expr = None
    for lo, hi, label in TENURE_SQL_BANDS:
        cond = t.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(TENURE_SQL_OTHER)


def tenure_band_cut(c="tenure_months", fill_null: bool = True,
                    out_of_range: str | None = "nan",
                    edges=TENURE_CUT_EDGES, labels=TENURE_BAND_LABELS) -> Column:
    """Right-closed intervals (e0, e1], (e1, e2], ...

    ``fill_null`` replaces NULL by 0 first; values outside every interval (and
    NULL when not filled) become ``out_of_range`` -- the string ``'nan'`` for the
    string-typed cut, ``None`` for the categorical cut whose missing values
    drop out of a later group-by.
    """
    t = _col(c)
    if fill_null:
        t = F.coalesce(F.nanvl(t.cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (t > F.lit(lo)) & (t <= F.lit(hi))
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr.otherwise(F.lit(out_of_range).cast("string"))
