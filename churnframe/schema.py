"""Data contracts: headers, column groups, table schemas and policy constants."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference system's for identical results.
# Raw extract headers (required, in order) and their snake_case names.
# ---------------------------------------------------------------------------
HEADER_TO_COLUMN = {
    "CustomerID": "customer_id",
    "Gender": "gender",
    "Senior Citizen": "senior_citizen",
    "Partner": "partner",
    "Dependents": "dependents",
    "Country": "country",
    "State": "state",
    "Contract": "contract_type",
    "Paperless Billing": "paperless_billing",
    "Payment Method": "payment_method",
    "Phone Service": "phone_service",
    "Multiple Lines": "multiple_lines",
    "Internet Service": "internet_service",
    "Online Security": "online_security",
    "Online Backup": "online_backup",
    "Device Protection": "device_protection",
    "Tech Support": "tech_support",
    "Streaming TV": "streaming_tv",
    "Streaming Movies": "streaming_movies",
    "Tenure Months": "tenure_months",
    "Monthly Charges": "monthly_charges",
    "Total Charges": "total_charges",
    "CLTV": "cltv",
    "Churn Label": "churn_label",
}
SNAPSHOT_DATE = "2026-01-28"
DEFAULT_THRESHOLD = 0.48
AGGRESSIVE_THRESHOLD = 0.28
MODES = ("default", "aggressive")
DEFAULT_MODE = "default"
ADDON_COLUMNS = ["online_security", "online_backup", "device_protection",
                 "tech_support", "streaming_tv", "streaming_movies"]
TENURE_CUT_EDGES = [-1, 12, 24, 48, 1200]
TENURE_BAND_LABELS = ["0-12", "13-24", "25-48", "49+"]
TENURE_SQL_BANDS = [(0, 12, "0-12"), (13, 24, "13-24"), (25, 48, "25-48")]
TENURE_SQL_OTHER = "49+"
NUMERIC_FEATURES = ["tenure_months", "monthly_charges", "total_charges", "cltv",
                    "avg_monthly_spend", "addon_count"]
DEFAULT_CATEGORICAL_BASE = [
    "gender", "partner", "dependents", "country", "state",
    "contract_type", "paperless_billing", "payment_method",
    "phone_service", "multiple_lines", "internet_service",
    "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies",
]
MONITORING_WINDOW = 1000
# ---------------------------------------------------------------------------

REQUIRED_HEADERS = list(HEADER_TO_COLUMN)

CUSTOMER_ATTRS = ["gender", "senior_citizen", "partner", "dependents", "country", "state"]
CONTRACT_COLS = ["contract_type", "paperless_billing", "payment_method"]
SERVICE_COLS = ["phone_service", "multiple_lines", "internet_service",
                "online_security", "online_backup", "device_protection",
                "tech_support", "streaming_tv", "streaming_movies"]
MEASURE_COLS = ["tenure_months", "monthly_charges", "total_charges", "cltv"]

# Column order of the flat training view (SELECT * order matters).
VIEW_COLUMNS = (["customer_id"] + CUSTOMER_ATTRS + CONTRACT_COLS + SERVICE_COLS
                + MEASURE_COLS + ["churn_target", "snapshot_date"])
ID_COLUMNS = ["customer_id", "snapshot_date"]
TARGET = "churn_target"
FEATURE_COLUMNS = [c for c in VIEW_COLUMNS if c not in ID_COLUMNS + [TARGET]]

# Named categorical feature sets (the reference used three different ones).
CATEGORICAL_SETS = {
    "default": DEFAULT_CATEGORICAL_BASE,
    "with_senior": ["senior_citizen"] + DEFAULT_CATEGORICAL_BASE,
}

RAW_SCHEMA = T.StructType(
    [T.StructField("row_id", T.LongType(), False)]
    + [T.StructField(h, T.StringType(), True) for h in REQUIRED_HEADERS])


def _fields(names: list[str], **types: T.DataType) -> list[T.StructField]:
    """Nullable columns, text unless given."""
    return [T.StructField(c, types.get(c, T.StringType())) for c in names]


# Stored star: surrogate keys are ingest positions.
DIM_CUSTOMER_SCHEMA = T.StructType([T.StructField("customer_key", T.LongType())]
                                   + _fields(["customer_id"] + CUSTOMER_ATTRS, senior_citizen=T.IntegerType()))
DIM_CONTRACT_SCHEMA = T.StructType([T.StructField("contract_key", T.LongType())] + _fields(CONTRACT_COLS))
DIM_SERVICES_SCHEMA = T.StructType([T.StructField("services_key", T.LongType())] + _fields(SERVICE_COLS))
FACT_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("snapshot_id", "customer_key", "contract_key", "services_key")]
    + _fields(MEASURE_COLS + ["churn_label", "snapshot_date"], tenure_months=T.IntegerType(),
              monthly_charges=T.DoubleType(), total_charges=T.DoubleType(), cltv=T.DoubleType()))

PREDICTION_LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("ts_utc", T.TimestampType(), False),
    T.StructField("request_id", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("churn_probability", T.DoubleType(), False),
    T.StructField("churn_flag", T.IntegerType(), False),
])

# Scoring request: 22 features + mode; only total_charges is optional.
REQUEST_SCHEMA = T.StructType(
    [T.StructField("request_id", T.StringType())]
    + [T.StructField(c, T.IntegerType() if c == "senior_citizen" else T.StringType())
       for c in CUSTOMER_ATTRS + CONTRACT_COLS + SERVICE_COLS]
    + [T.StructField("tenure_months", T.IntegerType()),
       T.StructField("monthly_charges", T.DoubleType()),
       T.StructField("total_charges", T.DoubleType()),
       T.StructField("cltv", T.DoubleType()),
       T.StructField("mode", T.StringType())])
