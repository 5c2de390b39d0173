"""Engineered feature expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnframe.functions.coerce import finite_or_null
from churnframe.schema import ADDON_COLUMNS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def addon_count(columns_present, addon_columns=ADDON_COLUMNS, yes: str = "Yes") -> Column:
    """Number of add-on columns equal to 'Yes'; NULL and other values count 0.
    Add-on columns missing from the frame are skipped."""
    present = set(columns_present)
    terms = [F.coalesce((F.col(c) == yes).cast("int"), F.lit(0))
             for c in addon_columns if c in present]
    if not terms:
        return F.lit(0)
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total.cast("int")


def avg_monthly_spend(tenure="tenure_months", total="total_charges") -> Column:
    """total / tenure when tenure > 0 (NULL tenure counts as 0), else 0.0;
    a NULL total stays NULL and infinities become NULL."""
    t = F.nanvl(_col(tenure).cast("double"), F.lit(None).cast("double"))
    tot = _col(total).cast("double")
    ratio = F.try_divide(tot, F.when(t != 0, t))
    return finite_or_null(F.when(F.coalesce(t, F.lit(0.0)) > 0, ratio).otherwise(F.lit(0.0)))


def engineer(df, addon_columns=ADDON_COLUMNS):
    """Stateless feature engineering (J1): keeps every input column, coerces
    the four measures, adds avg_monthly_spend, tenure_band and addon_count."""
    from churnframe.functions.bands import tenure_band_cut
    from churnframe.functions.coerce import safe_double

    types = dict(df.dtypes)
    out = df
    for c in ("tenure_months", "total_charges", "monthly_charges", "cltv"):
        if types.get(c) == "string":
            # text is parsed strictly; numeric columns keep their type
            out = out.withColumn(c, safe_double(c))
    return out.withColumns({
        "avg_monthly_spend": avg_monthly_spend("tenure_months", "total_charges"),
        "tenure_band": tenure_band_cut("tenure_months"),
        "addon_count": addon_count(df.columns, addon_columns),
    })
