from churnframe.functions.bands import tenure_band_cut, tenure_band_sql  # noqa: F401
from churnframe.functions.coerce import (  # noqa: F401
    blank_to_null, clean_total_charges, finite_or_null, int_default, safe_double)
from churnframe.functions.features import addon_count, avg_monthly_spend  # noqa: F401
from churnframe.functions.policy import churn_flag, threshold_for_mode  # noqa: F401
