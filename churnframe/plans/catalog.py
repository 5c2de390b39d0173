"""Registered queries: one per operator of the survey inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed over the
whole supplied tables (through the subscriber fixture, its raw extract, the
star schema or the prediction log derived from them).  ``ORACLE`` holds the
matching DuckDB SQL where one can be written; output column names agree.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.functions.bands import tenure_band_cut
from churnframe.functions.coerce import clean_total_charges, int_default, safe_double
from churnframe.functions.features import addon_count, avg_monthly_spend, engineer
from churnframe.functions.policy import churn_flag, threshold_for_mode
from churnframe.ml import pipeline as MP
from churnframe.ml import boosting as B
from churnframe.ml import explain as X
from churnframe.ml import forest as RF
from churnframe.ml.transformers import MedianImputer, ModeImputer
from churnframe.operators import analytics as A
from churnframe.operators import evaluate as E
from churnframe.operators import monitoring as M
from churnframe.operators import profile as P
from churnframe.operators import split as SP
from churnframe.operators import star as S
from churnframe.operators.validate import validate_requests
from churnframe.plans import oracle as O
from churnframe.plans.datasets import datasets
from churnframe.schema import (AGGRESSIVE_THRESHOLD, DEFAULT_CATEGORICAL_BASE, DEFAULT_THRESHOLD,
                               FEATURE_COLUMNS, NUMERIC_FEATURES, REQUEST_SCHEMA, SERVICE_COLS)
from churnframe.session import materialize, scratch_path
from churnframe.streaming import scoring as ST

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


W = O.with_chain
VIEW_SELECT = ", ".join(O.VIEW_COLS)

# ---------------------------------------------------------------- A: load


@query("raw_scan", W("SELECT * FROM raw"))
def raw_scan(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).raw


@query("raw_csv_scan", W("SELECT * FROM raw"))
def raw_csv_scan(spark, sf_dir) -> DataFrame:
    """The extract landed as CSV in the shared folder and read back with the
    explicit all-string contract schema (no inference)."""
    from churnframe.session import scratch_path as _sp
    from churnframe.sources.raw import read_raw, write_csv_extract
    path = _sp(spark, "extract_csv")
    write_csv_extract(datasets(spark, sf_dir).raw, path)
    return read_raw(spark, path, "csv")


@query("staging_clean", W("SELECT * FROM staging"))
def staging_clean(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).staging


@query("dim_customer_first_wins", W("SELECT * FROM dim_customer"))
def dim_customer_first_wins(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).star.dim_customer


@query("dim_contract", W("SELECT * FROM dim_contract"))
def dim_contract(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).star.dim_contract


@query("dim_services", W("SELECT * FROM dim_services"))
def dim_services(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).star.dim_services


@query("fact_snapshot", W("SELECT * FROM fact"))
def fact_snapshot(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).star.fact


@query("fact_dropped_rows", W(
    "SELECT s.row_id, s.customer_id, CASE WHEN s.customer_id IS NULL THEN 'null customer_id' "
    "WHEN " + " OR ".join(f"s.{c} IS NULL" for c in O.CONTRACT) + " THEN 'null contract key' "
    "WHEN " + " OR ".join(f"s.{c} IS NULL" for c in O.SERVICES) + " THEN 'null services key' "
    "ELSE 'unmatched key' END AS reason "
    "FROM staging s WHERE s.row_id NOT IN (SELECT snapshot_id FROM fact)"))
def fact_dropped(spark, sf_dir) -> DataFrame:
    d = datasets(spark, sf_dir)
    return S.fact_dropped_rows(d.staging, d.star)


@query("load_report", W(
    "SELECT 'dim_customer' AS table_name, COUNT(*) AS row_count FROM dim_customer "
    "UNION ALL SELECT 'dim_contract', COUNT(*) FROM dim_contract "
    "UNION ALL SELECT 'dim_services', COUNT(*) FROM dim_services "
    "UNION ALL SELECT 'fact_customer_snapshot', COUNT(*) FROM fact"))
def load_report(spark, sf_dir) -> DataFrame:
    return S.load_report(datasets(spark, sf_dir).star)


@query("dq_duplicate_keys", W(
    "SELECT 'dim_customer' AS table_name, customer_id AS natural_key, COUNT(*) AS n_rows "
    "FROM dim_customer WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING COUNT(*) > 1 "
    "UNION ALL SELECT 'dim_contract', concat_ws('|', " + ", ".join(O.CONTRACT) + "), COUNT(*) "
    "FROM dim_contract GROUP BY " + ", ".join(O.CONTRACT) + " HAVING COUNT(*) > 1 "
    "UNION ALL SELECT 'dim_services', concat_ws('|', " + ", ".join(O.SERVICES) + "), COUNT(*) "
    "FROM dim_services GROUP BY " + ", ".join(O.SERVICES) + " HAVING COUNT(*) > 1"))
def dq_duplicate_keys(spark, sf_dir) -> DataFrame:
    return S.dq_duplicate_keys(datasets(spark, sf_dir).star)


@query("dq_orphans", W(
    "SELECT 'customer_key' AS foreign_key, COUNT(*) AS orphan_rows FROM fact f "
    "WHERE f.customer_key NOT IN (SELECT customer_key FROM dim_customer) "
    "UNION ALL SELECT 'contract_key', COUNT(*) FROM fact f "
    "WHERE f.contract_key NOT IN (SELECT contract_key FROM dim_contract) "
    "UNION ALL SELECT 'services_key', COUNT(*) FROM fact f "
    "WHERE f.services_key NOT IN (SELECT services_key FROM dim_services)"))
def dq_orphans(spark, sf_dir) -> DataFrame:
    return S.dq_orphans(datasets(spark, sf_dir).star)


@query("surrogate_keys", W(
    "SELECT *, row_number() OVER (ORDER BY customer_key) AS dense_key FROM dim_customer"))
def surrogate_keys(spark, sf_dir) -> DataFrame:
    return S.dense_keys(datasets(spark, sf_dir).star.dim_customer, "customer_key")


# Incremental load: the accounts older than six years are loaded first, then
# the full extract is merged in.  Existing rows never change; new customers
# get keys after the existing maximum, in ingest order.
HISTORY = "tenure_months >= 72"


@query("dim_customer_merge", W(
    "SELECT * FROM old_dim UNION ALL "
    "SELECT n.customer_key + (SELECT MAX(customer_key) FROM old_dim) AS customer_key, "
    "n.customer_id, " + ", ".join("n." + c for c in O.CUST) + " FROM dim_customer n "
    "WHERE n.customer_id NOT IN (SELECT customer_id FROM old_dim WHERE customer_id IS NOT NULL)",
    "old_dim AS (SELECT row_id AS customer_key, customer_id, " + ", ".join(O.CUST) +
    " FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_id) AS rn "
    f"FROM staging WHERE customer_id IS NOT NULL AND {HISTORY}) t WHERE rn = 1)"))
def dim_customer_merge(spark, sf_dir) -> DataFrame:
    d = datasets(spark, sf_dir)
    old = S.build_dim_customer(d.staging.where(HISTORY))
    return S.merge_dimension(old, S.build_dim_customer(d.staging), ["customer_id"],
                             "customer_key")


@query("dim_services_rerun_noop", W("SELECT * FROM dim_services"))
def dim_services_rerun_noop(spark, sf_dir) -> DataFrame:
    """Loading the same batch twice adds no dimension rows (trap T1 fixed)."""
    d = datasets(spark, sf_dir)
    _, ds = S.small_dimensions(d.staging, materialize_result=False)
    return S.merge_dimension(d.star.dim_services, ds, SERVICE_COLS, "services_key")


@query("feature_matrix", W(
    "SELECT snapshot_id, " + ", ".join(c for c in O.VIEW_COLS
                                        if c not in ("customer_id", "snapshot_date",
                                                     "churn_target")) +
    ", churn_target AS label FROM vw"))
def feature_matrix(spark, sf_dir) -> DataFrame:
    """The 22 model features (identifier, constant date and target dropped)
    with the integer label alongside."""
    from churnframe.schema import FEATURE_COLUMNS, TARGET
    v = datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                          keep_snapshot_id=True)
    return v.select("snapshot_id", *FEATURE_COLUMNS, F.col(TARGET).cast("int").alias("label"))


@query("training_view", W(f"SELECT {VIEW_SELECT} FROM vw"))
def training_view_q(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).view


# ---------------------------------------------------------------- B: scalar


@query("coerce_numeric", W(
    "SELECT row_id, \"Monthly Charges\" AS monthly_charges_raw, "
    f"{O._safe_double(chr(34) + 'Monthly Charges' + chr(34))} AS monthly_charges, "
    "\"CLTV\" AS cltv_raw, "
    f"{O._safe_double(chr(34) + 'CLTV' + chr(34))} AS cltv FROM raw"))
def coerce_numeric(spark, sf_dir) -> DataFrame:
    raw = datasets(spark, sf_dir).raw
    return raw.select("row_id", F.col("Monthly Charges").alias("monthly_charges_raw"),
                      safe_double("Monthly Charges").alias("monthly_charges"),
                      F.col("CLTV").alias("cltv_raw"), safe_double("CLTV").alias("cltv"))


@query("coerce_int_default", W(
    "SELECT row_id, \"Senior Citizen\" AS senior_citizen_raw, "
    f"{O._int_default(chr(34) + 'Senior Citizen' + chr(34))} AS senior_citizen, "
    "\"Tenure Months\" AS tenure_months_raw, "
    f"{O._int_default(chr(34) + 'Tenure Months' + chr(34))} AS tenure_months FROM raw"))
def coerce_int_default(spark, sf_dir) -> DataFrame:
    raw = datasets(spark, sf_dir).raw
    return raw.select("row_id", F.col("Senior Citizen").alias("senior_citizen_raw"),
                      int_default("Senior Citizen").alias("senior_citizen"),
                      F.col("Tenure Months").alias("tenure_months_raw"),
                      int_default("Tenure Months").alias("tenure_months"))


@query("clean_total_charges", W(
    "SELECT row_id, \"Total Charges\" AS total_charges_raw, "
    f"{O._clean_total(chr(34) + 'Total Charges' + chr(34))} AS total_charges FROM raw"))
def clean_total_charges_q(spark, sf_dir) -> DataFrame:
    raw = datasets(spark, sf_dir).raw
    return raw.select("row_id", F.col("Total Charges").alias("total_charges_raw"),
                      clean_total_charges("Total Charges").alias("total_charges"))


@query("tenure_band_cut", W(
    f"SELECT snapshot_id, tenure_months, {O.cut_band_sql('tenure_months')} AS tenure_band "
    "FROM vw"))
def tenure_band_cut_q(spark, sf_dir) -> DataFrame:
    v = datasets(spark, sf_dir).view_with((), keep_snapshot_id=True)
    return v.select("snapshot_id", "tenure_months",
                    tenure_band_cut("tenure_months").alias("tenure_band"))


_RAW_TENURE = O._safe_double('"Tenure Months"')


@query("tenure_band_variants", W(
    f"SELECT row_id, t AS tenure, {O.cut_band_sql('t')} AS band_filled, "
    f"{O.cut_band_sql('t', fill=False)} AS band_string, "
    f"{O.cut_band_sql('t', null_label=None, fill=False)} AS band_category "
    f"FROM (SELECT row_id, {_RAW_TENURE} AS t FROM raw) r"))
def tenure_band_variants(spark, sf_dir) -> DataFrame:
    """The three cut flavours on the *uncleaned* tenure (NULL where unparsable)."""
    raw = datasets(spark, sf_dir).raw
    t = raw.select("row_id", safe_double("Tenure Months").alias("tenure"))
    return t.select("row_id", "tenure",
                    tenure_band_cut("tenure").alias("band_filled"),
                    tenure_band_cut("tenure", fill_null=False).alias("band_string"),
                    tenure_band_cut("tenure", fill_null=False, out_of_range=None)
                    .alias("band_category"))


@query("addon_count", W(f"SELECT snapshot_id, {O.addon_sum_sql()} AS addon_count FROM vw"))
def addon_count_q(spark, sf_dir) -> DataFrame:
    v = datasets(spark, sf_dir).view_with(("services",), keep_snapshot_id=True)
    return v.select("snapshot_id", addon_count(v.columns).alias("addon_count"))


@query("avg_monthly_spend", W(
    f"SELECT snapshot_id, tenure_months, total_charges, {O.avg_spend_sql()} "
    "AS avg_monthly_spend FROM vw"))
def avg_monthly_spend_q(spark, sf_dir) -> DataFrame:
    v = datasets(spark, sf_dir).view_with((), keep_snapshot_id=True)
    return v.select("snapshot_id", "tenure_months", "total_charges",
                    avg_monthly_spend().alias("avg_monthly_spend"))


# ---------------------------------------------------------------- D: analytics

_RATE = "ROUND(100.0 * AVG(churn_target), 2) AS churn_rate_pct, COUNT(*) AS customers"


@query("churn_by_contract", W(
    f"SELECT contract_type, {_RATE} FROM vw GROUP BY contract_type ORDER BY churn_rate_pct DESC"))
def churn_by_contract(spark, sf_dir) -> DataFrame:
    return A.churn_by_contract(datasets(spark, sf_dir).view_with(("contract",)))


@query("churn_by_tenure_band", W(
    f"SELECT {O.sql_band_sql('tenure_months')} AS tenure_band, {_RATE} FROM vw "
    "GROUP BY 1 ORDER BY tenure_band"))
def churn_by_tenure_band(spark, sf_dir) -> DataFrame:
    return A.churn_by_tenure_band(datasets(spark, sf_dir).view_with(()))


@query("revenue_at_risk", W(
    "SELECT churn_target, ROUND(SUM(monthly_charges), 2) AS total_monthly_charges, "
    "ROUND(AVG(monthly_charges), 2) AS avg_monthly_charges, COUNT(*) AS customers "
    "FROM vw GROUP BY churn_target"))
def revenue_at_risk(spark, sf_dir) -> DataFrame:
    return A.revenue_at_risk(datasets(spark, sf_dir).view_with(()))


@query("churn_by_internet_service", W(
    f"SELECT internet_service, {_RATE} FROM vw GROUP BY internet_service "
    "ORDER BY churn_rate_pct DESC"))
def churn_by_internet_service(spark, sf_dir) -> DataFrame:
    return A.churn_by_internet_service(datasets(spark, sf_dir).view_with(("services",)))


@query("churn_by_addon_count", W(
    f"SELECT addon_count, {_RATE} FROM (SELECT churn_target, {O.addon_sum_sql()} AS addon_count "
    "FROM vw) svc GROUP BY addon_count ORDER BY addon_count"))
def churn_by_addon_count(spark, sf_dir) -> DataFrame:
    return A.churn_by_addon_count(datasets(spark, sf_dir).view_with(("services",)))


@query("churn_mean_by_band_complete", W(
    "SELECT d.tenure_band, m.churn_mean, COALESCE(m.customers, 0) AS customers FROM "
    "(VALUES ('0-12'), ('13-24'), ('25-48'), ('49+')) d(tenure_band) LEFT JOIN "
    f"(SELECT {O.cut_band_sql('tenure_months', null_label=None, fill=False)} AS tenure_band, "
    "AVG(churn_target) AS churn_mean, COUNT(*) AS customers FROM vw GROUP BY 1) m "
    "ON m.tenure_band = d.tenure_band"))
def churn_mean_by_band_complete(spark, sf_dir) -> DataFrame:
    return A.churn_mean_by_band(datasets(spark, sf_dir).view_with(()))


@query("label_share_by_contract", W(
    "SELECT contract_type, churn_target, COUNT(*) AS n, "
    "COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY contract_type) AS rate "
    "FROM vw WHERE contract_type IS NOT NULL GROUP BY contract_type, churn_target"))
def label_share_by_contract(spark, sf_dir) -> DataFrame:
    return A.label_share_by(datasets(spark, sf_dir).view_with(("contract",)))


@query("target_share", W(
    "SELECT churn_target, COUNT(*) AS n, COUNT(*) / SUM(COUNT(*)) OVER () AS share "
    "FROM vw GROUP BY churn_target"))
def target_share(spark, sf_dir) -> DataFrame:
    return A.target_share(datasets(spark, sf_dir).view_with(()))


@query("target_counts", W(
    "SELECT churn_target, COUNT(*) AS n FROM vw GROUP BY churn_target ORDER BY n DESC"))
def target_counts(spark, sf_dir) -> DataFrame:
    return A.target_counts(datasets(spark, sf_dir).view_with(()))




# ---------------------------------------------------------------- D: profiling

_VIEW_NUMERIC = ["senior_citizen", "tenure_months", "monthly_charges", "total_charges", "cltv",
                 "churn_target"]
_VIEW_STRING = [c for c in O.VIEW_COLS if c not in _VIEW_NUMERIC]
_VIEW_TYPES = {c: ("INTEGER" if c in ("senior_citizen", "tenure_months", "churn_target")
                   else "DOUBLE" if c in _VIEW_NUMERIC else "VARCHAR") for c in O.VIEW_COLS}
ENG = (f"eng AS (SELECT *, {O.avg_spend_sql()} AS avg_monthly_spend, "
       f"{O.cut_band_sql('tenure_months')} AS tenure_band, "
       f"{O.addon_sum_sql()} AS addon_count FROM vw)")


def _nulls_sql(cols, positive=False, top=10):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM vw" for c in cols)
    where = "WHERE null_count > 0 " if positive else ""
    return f"SELECT * FROM ({parts}) t {where}ORDER BY null_count DESC, column_name LIMIT {top}"


@query("null_counts_top", W(_nulls_sql(O.VIEW_COLS)))
def null_counts_top(spark, sf_dir) -> DataFrame:
    return P.null_counts(datasets(spark, sf_dir).view, top=10)


@query("null_counts_positive", W(_nulls_sql(FEATURE_COLUMNS, positive=True, top=20)))
def null_counts_positive(spark, sf_dir) -> DataFrame:
    return P.null_counts(datasets(spark, sf_dir).view.select(*FEATURE_COLUMNS), top=20,
                         positive_only=True)


@query("column_info", W(" UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS position, '{c}' AS column_name, "
    f"COUNT({c}) AS non_null_count, '{_VIEW_TYPES[c]}' AS dtype FROM vw"
    for i, c in enumerate(O.VIEW_COLS))))
def column_info(spark, sf_dir) -> DataFrame:
    return P.column_info(datasets(spark, sf_dir).view)


@query("dataset_shape", W(f"SELECT COUNT(*) AS n_rows, {len(O.VIEW_COLS)} AS n_columns FROM vw"))
def dataset_shape(spark, sf_dir) -> DataFrame:
    return P.dataset_shape(datasets(spark, sf_dir).view)


def _describe_sql(c):
    x = f"CAST({c} AS DOUBLE)"
    quant = O.quantile_sql("vw", c, [0.25, 0.5, 0.75])
    return (f"SELECT '{c}' AS column_name, b.n AS count, b.mean, "
            f"CASE WHEN b.n > 1 THEN sqrt(CAST((SELECT SUM(CAST(({x} - b.mean) * ({x} - b.mean) / "
            f"CAST(b.n - 1 AS DOUBLE) AS DECIMAL(38,18))) FROM vw WHERE {c} IS NOT NULL) AS DOUBLE)) "
            f"END AS std, b.mn AS min, z.q0 AS q25, z.q1 AS q50, z.q2 AS q75, b.mx AS max "
            f"FROM (SELECT COUNT({c}) AS n, CAST(SUM(CAST({x} AS DECIMAL(38,18))) AS DOUBLE) / "
            f"CAST(COUNT({c}) AS DOUBLE) AS mean, MIN({x}) AS mn, MAX({x}) AS mx FROM vw) b, "
            f"({quant}) z")


@query("describe_numeric", W(" UNION ALL ".join(_describe_sql(c) for c in _VIEW_NUMERIC)))
def describe_numeric(spark, sf_dir) -> DataFrame:
    return P.describe_numeric(datasets(spark, sf_dir).view, _VIEW_NUMERIC)


def _mode_sql(cols, src="vw", value_alias="top", count_alias="freq", with_summary=True):
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {src}" for c in cols)
    counts = (f"SELECT column_name, value, COUNT(*) AS n FROM ({parts}) l "
              "WHERE value IS NOT NULL GROUP BY column_name, value")
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) "
              f"AS r FROM ({counts}) c")
    top = f"SELECT column_name, value AS {value_alias}, n AS {count_alias} FROM ({ranked}) x WHERE r = 1"
    if not with_summary:
        return top
    summ = (f"SELECT column_name, CAST(SUM(n) AS BIGINT) AS count, COUNT(*) AS \"unique\" "
            f"FROM ({counts}) c "
            "GROUP BY column_name")
    return (f"SELECT s.column_name, s.count, s.\"unique\", t.{value_alias}, t.{count_alias} "
            f"FROM ({summ}) s JOIN ({top}) t ON s.column_name = t.column_name")


@query("describe_categorical", W(_mode_sql(_VIEW_STRING)))
def describe_categorical(spark, sf_dir) -> DataFrame:
    return P.describe_categorical(datasets(spark, sf_dir).view, _VIEW_STRING)


def _box_sql(value, src):
    q = (f"SELECT c.churn_target, c.n, z.q0 AS q1, z.q1 AS median, z.q2 AS q3 FROM "
         f"(SELECT churn_target, COUNT(*) AS n FROM {src} WHERE {value} IS NOT NULL "
         f"GROUP BY churn_target) c JOIN ("
         f"{O.quantile_sql(src, value, [0.25, 0.5, 0.75], group='churn_target')}) z "
         "ON z.g = c.churn_target")
    f = ("SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, "
         f"q3 + 1.5 * (q3 - q1) AS upper_fence FROM ({q}) q")
    return (f"SELECT b.churn_target, b.n, b.q1, b.median, b.q3, b.iqr, b.lower_fence, "
            f"b.upper_fence, MIN(CASE WHEN s.{value} BETWEEN b.lower_fence AND b.upper_fence "
            f"THEN s.{value} END) AS whisker_low, "
            f"MAX(CASE WHEN s.{value} BETWEEN b.lower_fence AND b.upper_fence "
            f"THEN s.{value} END) AS whisker_high, "
            f"CAST(SUM(CASE WHEN s.{value} BETWEEN b.lower_fence AND b.upper_fence THEN 0 ELSE 1 "
            f"END) AS BIGINT) AS n_outliers FROM ({f}) b JOIN {src} s ON s.churn_target = b.churn_target "
            f"AND s.{value} IS NOT NULL GROUP BY ALL")


@query("box_stats_monthly_charges", W(_box_sql("monthly_charges", "vw")))
def box_stats_monthly_charges(spark, sf_dir) -> DataFrame:
    return P.box_stats(datasets(spark, sf_dir).view_with(()), "monthly_charges", "churn_target")


@query("box_stats_avg_spend", W(_box_sql("avg_monthly_spend", "eng"), ENG))
def box_stats_avg_spend(spark, sf_dir) -> DataFrame:
    return P.box_stats(engineer(datasets(spark, sf_dir).view_with(("services",))),
                       "avg_monthly_spend", "churn_target")


@query("tenure_histogram", W(
    "SELECT bin, churn_target, lo + bin * width AS bin_start, lo + (bin + 1) * width AS bin_end, "
    "COUNT(*) AS n FROM (SELECT churn_target, lo, width, CAST(CASE WHEN width > 0 THEN "
    "least(floor((CAST(tenure_months AS DOUBLE) - lo) / width), 39) ELSE 0 END AS INTEGER) "
    "AS bin FROM vw, (SELECT MIN(CAST(tenure_months AS DOUBLE)) AS lo, "
    "(MAX(CAST(tenure_months AS DOUBLE)) - MIN(CAST(tenure_months AS DOUBLE))) / 40.0 AS width "
    "FROM vw) r WHERE tenure_months IS NOT NULL) b GROUP BY bin, churn_target, lo, width"))
def tenure_histogram(spark, sf_dir) -> DataFrame:
    return P.histogram(datasets(spark, sf_dir).view_with(()), "tenure_months", "churn_target", 40)


def _rounded_sql(value: str, nbins: int = 40) -> str:
    """The first width of 1, 2, 5 times a power of ten with few enough bins."""
    at = lambda x: f"floor(CASE WHEN k >= 0 THEN {x} / (m * pow(10E0, k)) ELSE {x} * pow(10E0, -k) / m END)"
    edge = lambda b: f"CASE WHEN k >= 0 THEN ({b}) * (m * pow(10E0, k)) ELSE ({b}) * m / pow(10E0, -k) END"
    return (f"SELECT CAST(a - first AS INTEGER) AS bin, churn_target, {edge('a')} AS bin_start, {edge('a + 1')} AS bin_end, "
            f"COUNT(*) AS n FROM (SELECT churn_target, m, k, first, {at('x')} AS a FROM (SELECT churn_target, CAST({value} AS DOUBLE) "
            f"AS x FROM vw WHERE {value} IS NOT NULL) v, (SELECT m, k, {at('lo')} AS first FROM (SELECT MIN(CAST({value} AS DOUBLE)) "
            f"AS lo, MAX(CAST({value} AS DOUBLE)) AS hi FROM vw) r, (SELECT unnest([1E0, 2E0, 5E0]) AS m) mm, "
            f"(SELECT range AS k FROM range(-9, 12)) kk WHERE {at('hi')} - {at('lo')} < {nbins} ORDER BY k, m LIMIT 1) w) b "
            "GROUP BY a, first, m, k, churn_target")


@query("tenure_histogram_rounded", W(_rounded_sql("tenure_months")))
def tenure_histogram_rounded(spark, sf_dir) -> DataFrame:
    return P.rounded_histogram(datasets(spark, sf_dir).view_with(()), "tenure_months", "churn_target", 40)


@query("charges_histogram_rounded", W(_rounded_sql("monthly_charges")))
def charges_histogram_rounded(spark, sf_dir) -> DataFrame:
    return P.rounded_histogram(datasets(spark, sf_dir).view_with(()), "monthly_charges", "churn_target", 40)


@query("impute_median_fit", W(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, q0 AS median FROM ({O.quantile_sql('eng', c, [0.5])}) z"
    for c in NUMERIC_FEATURES), ENG))
def impute_median_fit(spark, sf_dir) -> DataFrame:
    return P.medians(engineer(datasets(spark, sf_dir).view_with(("services",))), NUMERIC_FEATURES)


_MODE_COLS = ["senior_citizen"] + DEFAULT_CATEGORICAL_BASE + ["tenure_band"]


@query("impute_mode_fit", W(_mode_sql(_MODE_COLS, src="eng", value_alias="fill_value",
                                      with_summary=False), ENG))
def impute_mode_fit(spark, sf_dir) -> DataFrame:
    return P.most_frequent(engineer(datasets(spark, sf_dir).view), _MODE_COLS)


# ---------------------------------------------------------------- evaluation

DT, AT = DEFAULT_THRESHOLD, AGGRESSIVE_THRESHOLD
SCORED = ("scored AS (SELECT snapshot_id, churn_target AS label, "
          "1 - CAST((snapshot_id * 7919) % 100 AS DOUBLE) / 128 AS score FROM vw)")
PR = (SCORED + ",\ng AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg "
      "FROM scored GROUP BY score),\n"
      "c AS (SELECT score, SUM(pos) OVER (ORDER BY score DESC) AS tp, "
      "SUM(neg) OVER (ORDER BY score DESC) AS fp FROM g),\n"
      "pr AS (SELECT score AS threshold, tp / (tp + fp) AS precision, "
      "tp / (SELECT SUM(label) FROM scored) AS recall, CAST(tp AS BIGINT) AS tp, "
      "CAST(fp AS BIGINT) AS fp FROM c)")


def _scored(spark, sf_dir) -> DataFrame:
    v = datasets(spark, sf_dir).view_with((), keep_snapshot_id=True)
    return v.select("snapshot_id", F.col("churn_target").alias("label"),
                    E.deterministic_score().alias("score"))


def _pr(spark, sf_dir) -> DataFrame:
    return E.pr_curve(_scored(spark, sf_dir))


@query("pr_curve", W("SELECT * FROM pr", PR))
def pr_curve(spark, sf_dir) -> DataFrame:
    return _pr(spark, sf_dir)


@query("pr_top_recall", W("SELECT threshold, precision, recall FROM pr "
                          "ORDER BY recall DESC, threshold DESC LIMIT 5", PR))
def pr_top_recall(spark, sf_dir) -> DataFrame:
    return E.top_by(_pr(spark, sf_dir), "recall", 5)


@query("pr_top_threshold", W("SELECT threshold, precision, recall FROM pr "
                             "ORDER BY threshold DESC LIMIT 5", PR))
def pr_top_threshold(spark, sf_dir) -> DataFrame:
    return E.top_by(_pr(spark, sf_dir), "threshold", 5)


def _best_sql(floor):
    return W("SELECT threshold, precision, recall FROM pr WHERE recall >= " + str(floor) +
             " ORDER BY precision DESC, recall DESC, threshold DESC LIMIT 10", PR)


@query("best_threshold_080", _best_sql(0.8))
def best_threshold_080(spark, sf_dir) -> DataFrame:
    return E.best_thresholds(_pr(spark, sf_dir), 0.80)


@query("best_threshold_085", _best_sql(0.85))
def best_threshold_085(spark, sf_dir) -> DataFrame:
    return E.best_thresholds(_pr(spark, sf_dir), 0.85)


@query("roc_auc", W(
    "SELECT CAST(SUM(pos * (2 * below + neg)) AS DOUBLE) / (2.0 * CAST(SUM(pos) AS DOUBLE) * "
    "CAST(SUM(neg) AS DOUBLE)) AS auc, CAST(SUM(pos) AS BIGINT) AS n_pos, "
    "CAST(SUM(neg) AS BIGINT) AS n_neg FROM "
    "(SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS below FROM g) t",
    SCORED + ",\ng AS (SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg "
    "FROM scored GROUP BY score)"))
def roc_auc(spark, sf_dir) -> DataFrame:
    return E.roc_auc(_scored(spark, sf_dir))


_CM = (SCORED + ",\ncm AS (SELECT "
       f"SUM(CASE WHEN label = 1 AND score >= {DT} THEN 1 ELSE 0 END) AS tp, "
       f"SUM(CASE WHEN label = 0 AND score >= {DT} THEN 1 ELSE 0 END) AS fp, "
       f"SUM(CASE WHEN label = 1 AND score < {DT} THEN 1 ELSE 0 END) AS fn, "
       f"SUM(CASE WHEN label = 0 AND score < {DT} THEN 1 ELSE 0 END) AS tn FROM scored),\n"
       "m AS (SELECT CASE WHEN tn + fn > 0 THEN CAST(tn AS DOUBLE) / (tn + fn) ELSE 0.0 END AS p0, "
       "CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE 0.0 END AS r0, "
       "CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS p1, "
       "CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS r1, "
       "tn + fp AS s0, tp + fn AS s1, tp + tn AS ok FROM cm),\n"
       "m2 AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2.0 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0, "
       "CASE WHEN p1 + r1 > 0 THEN 2.0 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1, "
       "s0 + s1 AS n FROM m)")


@query("classification_report", W(
    "SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1_score, "
    "CAST(s0 AS BIGINT) AS support FROM m2 UNION ALL "
    "SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM m2 UNION ALL "
    "SELECT 'accuracy', NULL, NULL, CAST(ok AS DOUBLE) / CAST(n AS DOUBLE), CAST(n AS BIGINT) "
    "FROM m2 UNION ALL "
    "SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, CAST(n AS BIGINT) "
    "FROM m2 UNION ALL "
    "SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, "
    "(f0 * s0 + f1 * s1) / n, CAST(n AS BIGINT) FROM m2", _CM))
def classification_report(spark, sf_dir) -> DataFrame:
    s = _scored(spark, sf_dir).withColumn("prediction", churn_flag("score", F.lit(DT)))
    return E.classification_report(s)


@query("class_weights", W(
    "SELECT churn_target, COUNT(*) AS n_c, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / "
    "CAST(COUNT(*) OVER () * COUNT(*) AS DOUBLE) AS weight FROM vw GROUP BY churn_target"))
def class_weights(spark, sf_dir) -> DataFrame:
    return SP.class_weights(datasets(spark, sf_dir).view_with(()), "churn_target")


@query("stratified_split", W(
    "SELECT o.snapshot_id, o.churn_target, CASE WHEN o.r <= q.q THEN 'train' ELSE 'test' END AS split FROM "
    "(SELECT snapshot_id, churn_target, row_number() OVER (PARTITION BY churn_target ORDER BY "
    "substr(md5('42:' || CAST(snapshot_id AS VARCHAR)), 1, 13), snapshot_id) AS r FROM vw) o "
    "JOIN quota q ON o.churn_target = q.churn_target",
    "cnt AS (SELECT churn_target, COUNT(*) AS n_c FROM vw GROUP BY churn_target),\n"
    "tot AS (SELECT SUM(n_c) AS n, SUM(n_c) - CAST(ceil(0.2 * SUM(n_c)) AS BIGINT) AS n_train "
    "FROM cnt),\n"
    "cont AS (SELECT churn_target, n_c, n_train * n_c / n AS c, floor(n_train * n_c / n) AS fl, "
    "n_train FROM cnt, tot),\n"
    "rk AS (SELECT *, row_number() OVER (ORDER BY c - fl DESC, churn_target) AS r, "
    "n_train - SUM(fl) OVER () AS lft FROM cont),\n"
    "quota AS (SELECT churn_target, n_c, fl + CASE WHEN r <= lft THEN 1 ELSE 0 END AS q FROM rk)"))
def stratified_split_q(spark, sf_dir) -> DataFrame:
    """Membership of every account."""
    v = datasets(spark, sf_dir).view_with((), keep_snapshot_id=True)
    return SP.stratified_split(v, "churn_target", "snapshot_id").select("snapshot_id", "churn_target", "split")


# ---------------------------------------------------------------- policy, monitoring
@query("decision_policy", W(
    "SELECT snapshot_id, score AS churn_probability, "
    f"CASE WHEN score >= {DT} THEN 1 ELSE 0 END AS flag_default, "
    f"CASE WHEN score >= {AT} THEN 1 ELSE 0 END AS flag_aggressive FROM scored", SCORED))
def decision_policy(spark, sf_dir) -> DataFrame:
    s = _scored(spark, sf_dir)
    return s.select("snapshot_id", F.col("score").alias("churn_probability"),
                    churn_flag("score", threshold_for_mode(F.lit("default")))
                    .alias("flag_default"),
                    churn_flag("score", threshold_for_mode(F.lit("aggressive")))
                    .alias("flag_aggressive"))


LOG = ("plog AS (SELECT event_id AS id, CAST(ts AS TIMESTAMP) AS ts_utc, "
       "'u' || CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) AS request_id, "
       "CASE WHEN event_type = 'purchase' THEN 'aggressive' ELSE 'default' END AS mode, "
       f"CASE WHEN event_type = 'purchase' THEN CAST({AT} AS DOUBLE) ELSE CAST({DT} AS DOUBLE) END "
       "AS threshold, least(value / 128, CAST(1 AS DOUBLE)) AS churn_probability FROM events),\n"
       "plog2 AS (SELECT *, CAST(CASE WHEN churn_probability >= threshold THEN 1 ELSE 0 END "
       "AS INTEGER) AS churn_flag FROM plog)")


@query("prediction_log", "WITH " + LOG + "\nSELECT * FROM plog2")
def prediction_log_q(spark, sf_dir) -> DataFrame:
    return datasets(spark, sf_dir).prediction_log


@query("monitoring_summary", "WITH " + LOG + "\nSELECT churn_flag, CAST(SUM(CAST(churn_probability AS DECIMAL(38,18))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS "
       "avg_probability, COUNT(*) AS count, 1000 AS window_size FROM "
       "(SELECT * FROM plog2 ORDER BY id DESC LIMIT 1000) t GROUP BY churn_flag")
def monitoring_summary(spark, sf_dir) -> DataFrame:
    return M.monitoring_summary(datasets(spark, sf_dir).prediction_log, 1000)


@query("monitoring_summary_all", "WITH " + LOG + "\nSELECT churn_flag, CAST(SUM(CAST(churn_probability AS DECIMAL(38,18))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) "
       "AS avg_probability, COUNT(*) AS count FROM plog2 GROUP BY churn_flag")
def monitoring_summary_all(spark, sf_dir) -> DataFrame:
    return M.monitoring_summary_all(datasets(spark, sf_dir).prediction_log)


_REQ_MODE = "CASE WHEN contract_type = 'Month-to-month' THEN 'aggressive' ELSE 'default' END"


def _violations_sql():
    from churnframe.operators.validate import REQUIRED
    parts = [f"CASE WHEN {c} IS NULL THEN '{c}_required' END" for c in REQUIRED]
    parts += ["CASE WHEN NOT (senior_citizen BETWEEN 0 AND 1) THEN 'senior_citizen_range' END",
              "CASE WHEN tenure_months < 0 THEN 'tenure_months_negative' END",
              "CASE WHEN monthly_charges < 0 THEN 'monthly_charges_negative' END",
              "CASE WHEN cltv < 0 THEN 'cltv_negative' END",
              "CASE WHEN mode NOT IN ('default', 'aggressive') "
              "THEN 'mode_invalid' END"]
    return "concat_ws(',', " + ", ".join(parts) + ")"


@query("validate_requests", W(
    f"SELECT snapshot_id, mode, v AS violations, v = '' AS is_valid FROM "
    f"(SELECT snapshot_id, mode, {_violations_sql()} AS v FROM "
    f"(SELECT *, {_REQ_MODE} AS mode FROM vw) r) t"))
def validate_requests_q(spark, sf_dir) -> DataFrame:
    """Each view row as a scoring request (mode from the contract type)."""
    v = datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                          keep_snapshot_id=True)
    req = v.withColumn("mode", F.expr(_REQ_MODE))
    return validate_requests(req).select("snapshot_id", "mode", "violations", "is_valid")


# ---------------------------------------------------------------- ML

_CATS = MP.categorical_columns("with_senior")


@query("engineered_features", W(
    "SELECT " + VIEW_SELECT + ", avg_monthly_spend, tenure_band, addon_count FROM eng", ENG))
def engineered_features(spark, sf_dir) -> DataFrame:
    return engineer(datasets(spark, sf_dir).view)


def _median_ctes():
    meds = ", ".join(f"(SELECT q0 FROM ({O.quantile_sql('eng', c, [0.5])}) z) AS m_{c}"
                     for c in NUMERIC_FEATURES)
    return ENG + f",\nmed AS (SELECT {meds})"


@query("imputed_numeric", W(
    "SELECT snapshot_id, " + ", ".join(
        f"COALESCE(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC_FEATURES) +
    " FROM eng, med", _median_ctes()))
def imputed_numeric(spark, sf_dir) -> DataFrame:
    eng = engineer(datasets(spark, sf_dir).view_with(("services",), keep_snapshot_id=True))
    model = MedianImputer(inputCols=NUMERIC_FEATURES).fit(eng)
    return model.transform(eng).select("snapshot_id", *NUMERIC_FEATURES)


@query("imputed_categorical", W(
    "SELECT e.snapshot_id, " + ", ".join(
        f"COALESCE(CAST(e.{c} AS VARCHAR), (SELECT fill_value FROM modes WHERE column_name = "
        f"'{c}')) AS {c}" for c in _CATS) + " FROM eng e",
    ENG + ",\nmodes AS (" + _mode_sql(_CATS, src="eng", value_alias="fill_value",
                                       with_summary=False) + ")"))
def imputed_categorical(spark, sf_dir) -> DataFrame:
    eng = engineer(datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                                     keep_snapshot_id=True))
    model = ModeImputer(inputCols=_CATS).fit(eng)
    return model.transform(eng).select("snapshot_id", *_CATS)


@query("one_hot_long", W(
    "SELECT snapshot_id, column_name, category, CAST(dense_rank() OVER (PARTITION BY "
    "column_name ORDER BY category) - 1 AS DOUBLE) AS slot FROM (" + " UNION ALL ".join(
        f"SELECT snapshot_id, '{c}' AS column_name, CAST({c} AS VARCHAR) AS category FROM eng"
        for c in _CATS) + ") l", ENG))
def one_hot_long(spark, sf_dir) -> DataFrame:
    """Category slot of every (row, categorical column): the alphabetical
    index the one-hot encoder uses (unknown -> the dropped extra slot)."""
    eng = ModeImputer(inputCols=_CATS).fit(
        engineer(datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                                   keep_snapshot_id=True)))
    data = eng.transform(engineer(datasets(spark, sf_dir).view_with(
        ("customer", "contract", "services"), keep_snapshot_id=True)))
    idx = [f"{c}__idx" for c in _CATS]
    ind = StringIndexer(inputCols=_CATS, outputCols=idx, stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(data).transform(data)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("category"),
                 F.col(i).alias("slot")) for c, i in zip(_CATS, idx)])).alias("_s")
    return ind.select("snapshot_id", stack).select("snapshot_id", "_s.*")


_CAT_UNION = " UNION ALL ".join(
    f"SELECT {k} AS ord, '{c}' AS column_name, CAST({c} AS VARCHAR) AS category FROM eng"
    for k, c in enumerate(_CATS))


@query("feature_names", W(
    " UNION ALL ".join(f"SELECT {i} AS position, 'num__{c}' AS feature_name"
                       for i, c in enumerate(NUMERIC_FEATURES)) +
    f" UNION ALL SELECT CAST({len(NUMERIC_FEATURES)} + o.off + dense_rank() OVER (PARTITION BY "
    "c.ord ORDER BY c.category) - 1 AS INTEGER) AS position, 'cat__' || c.column_name || '_' || "
    "c.category AS feature_name FROM cats c JOIN offs o ON o.ord = c.ord",
    ENG + ",\ncats AS (SELECT DISTINCT ord, column_name, category FROM (" + _CAT_UNION + ") u "
    "WHERE category IS NOT NULL),\n"
    "cols AS (SELECT ord, COUNT(*) AS nd FROM cats GROUP BY ord),\n"
    "offs AS (SELECT ord, COALESCE(SUM(nd) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING "
    "AND 1 PRECEDING), 0) AS off FROM cols)"))
def feature_names_q(spark, sf_dir) -> DataFrame:
    """Names of the assembled vector slots, fitted on the whole view."""
    eng = engineer(datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                                     keep_snapshot_id=True))
    prep = MP.build_preprocessor("with_senior").fit(eng)
    names = MP.feature_names(prep.transform(eng.limit(0)))
    return spark.createDataFrame(list(enumerate(names)), "position int, feature_name string")


def _requests(spark, sf_dir) -> DataFrame:
    """Every account of the view as a scoring request."""
    v = datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                          keep_snapshot_id=True)
    return v.withColumn("mode", F.expr(_REQ_MODE))


@query("score_batch")
def score_batch(spark, sf_dir) -> DataFrame:
    """All accounts through the one scoring path: validation -> features ->
    random-forest probability -> mode threshold -> flag (the logged response
    fields of the accepted requests)."""
    scored, _ = MP.score_requests(datasets(spark, sf_dir).model("rf"), _requests(spark, sf_dir))
    return scored.select("snapshot_id", "mode", "threshold", "churn_probability", "churn_flag")


@query("score_batch_check", W(
    "SELECT mode, v AS violations, COUNT(*) AS n_requests, CAST(0 AS BIGINT) AS n_wrong_flags FROM "
    f"(SELECT mode, {_violations_sql()} AS v FROM (SELECT *, {_REQ_MODE} AS mode FROM vw) r) t "
    "GROUP BY mode, v"))
def score_batch_check(spark, sf_dir) -> DataFrame:
    """Requests per mode and outcome ('' when accepted, else the rules broken)
    and accepted rows whose flag is not ``p >= threshold`` of the mode."""
    scored, bad = MP.score_requests(datasets(spark, sf_dir).model("rf"), _requests(spark, sf_dir))
    limit = F.when(F.col("mode") == "aggressive", F.lit(AT)).otherwise(F.lit(DT))
    wrong = F.col("churn_flag") != (F.col("churn_probability") >= limit).cast("int")
    rows = scored.select("mode", F.lit("").alias("violations"), wrong.alias("wrong")).unionByName(
        bad.select("mode", "violations", F.lit(False).alias("wrong")))
    return rows.groupBy("mode", "violations").agg(F.count(F.lit(1)).alias("n_requests"),
                                                  F.count_if("wrong").alias("n_wrong_flags"))


@query("score_batch_logged", W(
    "SELECT mode, COUNT(*) AS n_rows, COUNT(*) AS n_ids, COUNT(*) AS n_requests FROM "
    f"(SELECT mode, {_violations_sql()} AS v FROM (SELECT *, {_REQ_MODE} AS mode FROM vw) r) t WHERE v = '' GROUP BY mode"))
def score_batch_logged(spark, sf_dir) -> DataFrame:
    """All accounts scored into a prediction log; its committed rows, ids and
    requests by mode."""
    base = scratch_path(spark, "batch_log")
    req = _requests(spark, sf_dir).withColumn("request_id", F.concat(F.lit("r"), F.col("snapshot_id").cast("string")))
    ST.log_batch(spark, datasets(spark, sf_dir).model("rf"), req.select(*REQUEST_SCHEMA.fieldNames()), 0,
                 f"{base}/log", f"{base}/summary", f"{base}/quarantine")
    return ST.read_log(spark, f"{base}/log").groupBy("mode").agg(
        F.count("id").alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.countDistinct("request_id").alias("n_requests"))


@query("model_comparison")
def model_comparison(spark, sf_dir) -> DataFrame:
    """Logistic regression, random forest and gradient boosting on the same
    split: held-out AUC and class-1 precision/recall/F1 at 0.5."""
    d = datasets(spark, sf_dir)
    _, test = d.split
    out = None
    for kind in ("lr", "rf", "gbt"):
        s = materialize(MP.positive_probability(d.model(kind).transform(test))
                        .select("churn_probability", "label", "prediction"), "model_scores")
        auc = E.roc_auc(s.select(F.col("churn_probability").alias("score"), "label")).first()
        rep = E.classification_report(s.select("label", "prediction")) \
            .where(F.col("class_label") == "1").select("precision", "recall", "f1_score")
        row = rep.select(F.lit(kind).alias("model"), F.lit(float(auc.auc)).alias("auc"),
                         "precision", "recall", "f1_score")
        out = row if out is None else out.unionByName(row)
    return out


# features and fixed limits of a tree that SQL can grow as well
_BOOST = [("CAST(tenure_months AS DOUBLE)", [12, 24, 48]), ("coalesce(monthly_charges, 0)", [20, 40, 60, 80]),
          ("CAST(senior_citizen AS DOUBLE)", [0]), ("CASE WHEN contract_type = 'Month-to-month' THEN 1.0E0 ELSE 0.0E0 END", [0]),
          ("coalesce(cltv, 0)", [3000, 4000, 5000])]


def _boost_sql() -> str:
    """The first tree (depth 2, L2 weight 1, rate 0.05, no sampling), level by
    level: sums of gradient and hessian per node, feature and bin, running
    totals, gains, best split."""
    bins = " UNION ALL ".join(
        f"SELECT snapshot_id, y, {k} AS f, " + " + ".join(f"CAST({e} > {c} AS INTEGER)" for c in cuts) + f" AS b, {len(cuts)} AS nb FROM r"
        for k, (e, cuts) in enumerate(_BOOST))

    def level(name: str, nodes: str) -> str:
        return (f"{name}h AS (SELECT n.node, f, b, nb, SUM(0.5E0 - y) AS g, SUM(0.25E0) AS h FROM e JOIN ({nodes}) n "
                "ON e.snapshot_id = n.snapshot_id GROUP BY ALL),\n"
                f"{name}c AS (SELECT *, SUM(g) OVER w AS gl, SUM(h) OVER w AS hl, SUM(g) OVER t AS gt, SUM(h) OVER t AS ht FROM {name}h "
                "WINDOW w AS (PARTITION BY node, f ORDER BY b), t AS (PARTITION BY node, f)),\n"
                f"{name} AS (SELECT node, f, b, gain, gt, ht, gl, hl FROM (SELECT *, row_number() OVER (PARTITION BY node "
                "ORDER BY gain DESC, f, b) AS rk FROM (SELECT *, (gl * gl / (hl + 1E0) + (gt - gl) * (gt - gl) / (ht - hl + 1E0) "
                f"- gt * gt / (ht + 1E0)) * 0.5E0 AS gain FROM {name}c WHERE b < nb AND hl >= 1 AND ht - hl >= 1) q) q WHERE rk = 1 AND gain > 0)")
    child = ("SELECT e.snapshot_id, 2 * s.node + CAST(e.b > s.b AS INTEGER) AS node FROM e JOIN a s ON e.f = s.f")
    return W(
        "SELECT node, f AS feature, b AS bin, gain, gt AS grad, ht AS hess, CAST(NULL AS DOUBLE) AS value FROM a UNION ALL "
        "SELECT node, f, b, gain, gt, ht, NULL FROM c UNION ALL "
        "SELECT 2 * node, NULL, NULL, NULL, gl, hl, -0.05E0 * gl / (hl + 1E0) FROM c UNION ALL "
        "SELECT 2 * node + 1, NULL, NULL, NULL, gt - gl, ht - hl, -0.05E0 * (gt - gl) / (ht - hl + 1E0) FROM c",
        "r AS (SELECT *, CAST(churn_target AS DOUBLE) AS y FROM vw),\n" + f"e AS ({bins}),\n"
        + level("a", "SELECT DISTINCT snapshot_id, 1 AS node FROM e") + ",\n" + level("c", child))


@query("boost_first_tree", _boost_sql())
def boost_first_tree(spark, sf_dir) -> DataFrame:
    """Nodes of the first tree of second-order boosting over all accounts."""
    v = datasets(spark, sf_dir).view_with(("customer", "contract"), keep_snapshot_id=True)
    x = F.array(*[F.expr(e).cast("double") for e, _ in _BOOST])
    data = v.select("snapshot_id", F.col("churn_target").alias("label"), x.alias("features"))
    model = B.fit_boosting(data, "snapshot_id", rounds=1, depth=2, row_share=1.0, column_share=1.0, cuts=[c for _, c in _BOOST])
    return B.tree_table(model, 0, spark) if model.trees else B.tree_table(B.BoostedTrees([], [B.Tree.empty(0)]), 0, spark).limit(0)


#: trees whose bootstraps SQL draws as well
_FOREST_TREES = 60


def _forest_rows_sql() -> str:
    """(tree, label, id, c): rows of every bootstrap with their counts."""
    h = RF.bootstrap_hash_sql("CAST(snapshot_id AS BIGINT)", "tree", 42)
    count = " + ".join(f"CASE WHEN h >= {x} THEN 1 ELSE 0 END" for x in RF.LIMITS)
    return (f"SELECT * FROM (SELECT id, label, tree, {count} AS c FROM (SELECT snapshot_id AS id, churn_target AS label, tree, "
            f"{h} AS h FROM vw, (SELECT range AS tree FROM range({_FOREST_TREES})) t WHERE churn_target IS NOT NULL) a) q WHERE c > 0")


def _forest_weights_sql() -> str:
    return ("SELECT CAST(tree AS INTEGER) AS tree, CAST(label AS INTEGER) AS label, CAST(n AS BIGINT) AS n, "
            "CAST(SUM(n) OVER w AS DOUBLE) / CAST(COUNT(*) OVER w * n AS DOUBLE) AS weight FROM (SELECT tree, label, SUM(c) AS n "
            f"FROM ({_forest_rows_sql()}) b GROUP BY tree, label) n WINDOW w AS (PARTITION BY tree)")


def _forest_data(spark, sf_dir) -> DataFrame:
    v = datasets(spark, sf_dir).view_with(("customer", "contract"), keep_snapshot_id=True)
    x = F.array(*[F.expr(e).cast("double") for e, _ in _BOOST])
    return v.select("snapshot_id", F.col("churn_target").alias("label"), x.alias("features"))


@query("forest_class_weights", W(_forest_weights_sql()))
def forest_class_weights(spark, sf_dir) -> DataFrame:
    """Class weights of every tree's bootstrap of all accounts."""
    return RF.class_weights(_forest_data(spark, sf_dir), "snapshot_id", n_trees=_FOREST_TREES)


def _forest_root_sql() -> str:
    """Root split of every tree by the summed counts of (feature, bin)."""
    side = lambda a, b: f"2.0E0 * {a} * {b} / ({a} + {b})"
    cells = " UNION ALL ".join(
        f"SELECT snapshot_id AS id, {f} AS feature, {' + '.join(f'CASE WHEN {e} > {c} THEN 1 ELSE 0 END' for c in cuts)} AS bin, "
        f"{len(cuts)} AS bins FROM vw" for f, (e, cuts) in enumerate(_BOOST))
    chain = (f"b AS MATERIALIZED ({_forest_rows_sql()}), w AS (SELECT tree, MAX(CASE WHEN label = 0 THEN weight END) AS w0, "
            f"MAX(CASE WHEN label = 1 THEN weight END) AS w1 FROM ({_forest_weights_sql()}) z GROUP BY tree), "
            f"s AS (SELECT tree, feature, bin, bins, SUM(CASE WHEN label = 0 THEN c ELSE 0 END) AS n0, "
            f"SUM(CASE WHEN label = 1 THEN c ELSE 0 END) AS n1, COUNT(*) AS r FROM b JOIN ({cells}) x USING (id) "
            "GROUP BY tree, feature, bin, bins), "
            "l AS (SELECT tree, feature, bin, bins, w0 * SUM(n0) OVER o AS a, w1 * SUM(n1) OVER o AS b, SUM(r) OVER o AS r, "
            "w0 * SUM(n0) OVER t AS ta, w1 * SUM(n1) OVER t AS tb, SUM(r) OVER t AS rt FROM s JOIN w USING (tree) "
            "WINDOW t AS (PARTITION BY tree, feature), o AS (PARTITION BY tree, feature ORDER BY bin)), "
            f"g AS (SELECT *, {side('ta', 'tb')} - {side('a', 'b')} - {side('(ta - a)', '(tb - b)')} AS gain FROM l "
            "WHERE bin < bins AND r >= 20 AND rt - r >= 20)")
    return W("SELECT CAST(tree AS INTEGER) AS tree, CAST(feature AS INTEGER) AS feature, CAST(bin AS INTEGER) AS bin, "
            "CAST(r AS BIGINT) AS rows_left, round(gain, 6) AS gain FROM g QUALIFY row_number() OVER (PARTITION BY tree "
            "ORDER BY round(gain, 6) DESC, feature, bin) = 1", chain)


@query("forest_root_splits", _forest_root_sql())
def forest_root_splits(spark, sf_dir) -> DataFrame:
    """Root split of every tree, all features looked at."""
    data = _forest_data(spark, sf_dir)
    model = RF.fit_forest(data, "snapshot_id", n_trees=_FOREST_TREES, depth=1, cuts=[c for _, c in _BOOST],
                          columns_per_node=len(_BOOST))
    return RF.split_table(model, spark).filter("node = 1").select("tree", "feature", "bin", "rows_left", F.round("gain", 6).alias("gain"))


@query("forest_balanced")
def forest_balanced(spark, sf_dir) -> DataFrame:
    """The forest at full size (300 trees, depth 10, leaves of 20 rows, a
    balanced bootstrap a tree) on the training split: held-out AUC and class-1
    precision, recall and F1 at 0.5."""
    d = datasets(spark, sf_dir)
    train, test = d.split
    model = RF.fit_forest(d.preprocessor.transform(train).select("snapshot_id", "label", MP.FEATURES), "snapshot_id")
    s = materialize(RF.score_forest(model, d.preprocessor.transform(test)).select("churn_probability", "label", (
        F.col("churn_probability") >= 0.5).cast("double").alias("prediction")), "model_scores")
    auc = E.roc_auc(s.select(F.col("churn_probability").alias("score"), "label")).first()
    rep = E.classification_report(s.select("label", "prediction")).where(F.col("class_label") == "1")
    return rep.select(F.lit(len(model.trees)).alias("n_trees"), F.lit(float(auc.auc)).alias("auc"), "precision", "recall", "f1_score")


def _shap(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    """Every account explained (one row each, written once for the queries of
    a session) and the names of the feature slots."""
    d = datasets(spark, sf_dir)
    cache = d.__dict__.setdefault("_shap", {})
    if not cache:
        model = d.model("rf")
        feats = MP.positive_probability(model.transform(_requests(spark, sf_dir)))
        cache["names"] = MP.feature_names(feats)
        cache["rows"] = materialize(X.explain_rows(model.stages[-1], feats, "snapshot_id", carry=["churn_probability"]), "shap")
    return cache["rows"], cache["names"]


@query("shap_global")
def shap_global(spark, sf_dir) -> DataFrame:
    """Features ranked by mean |phi| over all accounts."""
    return X.mean_abs(*_shap(spark, sf_dir)).orderBy(F.desc("mean_abs_shap"), "feature_index")


@query("shap_additivity", W("SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_not_additive FROM vw"))
def shap_additivity(spark, sf_dir) -> DataFrame:
    """Accounts explained, and those whose base value and contributions do not
    add up to the model's probability."""
    return X.additivity(_shap(spark, sf_dir)[0], "churn_probability")


@query("shap_dependence")
def shap_dependence(spark, sf_dir) -> DataFrame:
    """(value, phi) pairs of num__tenure_months, and the value of the feature
    that goes with phi most strongly among accounts of about equal tenure."""
    rows, names = _shap(spark, sf_dir)
    i = names.index("num__tenure_months")
    best = X.interaction_scores(rows, "snapshot_id", i, names).orderBy(F.desc("score"), "feature_index").first()
    k = best["feature_index"] if best else 0
    return rows.select("snapshot_id", F.col("x")[i].alias("value"), F.col("phi")[i].alias("phi"),
                       F.lit(names[k]).alias("interaction_feature"), F.col("x")[k].alias("interaction_value"))


@query("shap_interaction")
def shap_interaction(spark, sf_dir) -> DataFrame:
    """Score of every other feature as the companion of num__tenure_months."""
    rows, names = _shap(spark, sf_dir)
    return X.interaction_scores(rows, "snapshot_id", names.index("num__tenure_months"), names)


@query("shap_local")
def shap_local(spark, sf_dir) -> DataFrame:
    """One account's explanation (the row with the smallest id), computed for
    that row alone: base value and per-feature phi, largest |phi| first."""
    model = datasets(spark, sf_dir).model("rf")
    requests = _requests(spark, sf_dir)
    first = requests.agg(F.min("snapshot_id")).first()[0]
    feats = model.transform(requests.filter(F.col("snapshot_id") == F.lit(first)))
    names = F.array(*[F.lit(n) for n in MP.feature_names(feats)])
    return (X.explain(model.stages[-1], feats, "snapshot_id")
            .select("snapshot_id", names[F.col("feature_index")].alias("feature_name"), "value", "phi", "base_value")
            .orderBy(F.desc(F.abs("phi")), "feature_name"))


# contributions that any engine can compute, to check the tables behind the plots
_DENSITY = ["tenure_months", "monthly_charges", "cltv"]


def _density_sql() -> str:
    parts = []
    for k, c in enumerate(_DENSITY):
        q = O.quantile_sql("vw", c, [0.05, 0.95])
        parts.append(
            f"SELECT '{c}' AS feature_name, CAST({c} AS DOUBLE) AS v, p, q0 AS a, q1 AS b, "
            f"MIN(CAST({c} AS DOUBLE)) OVER () AS v0, MAX(CAST({c} AS DOUBLE)) OVER () AS v1, "
            "MIN(p) OVER () AS p0, MAX(p) OVER () AS p1 FROM "
            f"(SELECT {c}, CAST((snapshot_id * 7919 + {k} * 104729) % 1000 AS DOUBLE) / 1024 - 0.5 AS p FROM vw "
            f"WHERE {c} IS NOT NULL) d, ({q}) z")
    return W("SELECT feature_name, CAST(CASE WHEN p1 > p0 THEN floor((p - p0) / (p1 - p0) * 100) ELSE 0 END AS BIGINT) AS bin, "
             "COUNT(*) AS n, CAST(SUM(CAST(floor(CASE WHEN hi > lo THEN (least(greatest(v, lo), hi) - lo) / (hi - lo) ELSE 0 END "
             "* 1099511627776) AS HUGEINT)) AS DOUBLE) / 1099511627776 / CAST(COUNT(*) AS DOUBLE) AS mean_scaled_value, "
             "MIN(p) AS phi_min, MAX(p) AS phi_max FROM (SELECT *, CASE WHEN a = b THEN v0 ELSE a END AS lo, "
             "CASE WHEN a = b THEN v1 ELSE b END AS hi FROM l) t GROUP BY 1, 2",
             "l AS (" + " UNION ALL ".join(parts) + ")")


@query("shap_summary_density", _density_sql())
def shap_summary_density(spark, sf_dir) -> DataFrame:
    """The summary plot's density and colour of deterministic contributions."""
    v = datasets(spark, sf_dir).view_with((), keep_snapshot_id=True)
    long = v.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("value"),
        (((F.col("snapshot_id") * 7919 + k * 104729) % 1000).cast("double") / 1024 - 0.5).alias("phi"))
        for k, c in enumerate(_DENSITY)])).alias("f")).select("f.*")
    return X.summary_density(long)


@query("shap_summary")
def shap_summary(spark, sf_dir) -> DataFrame:
    """The summary plot of the fitted forest: density of phi and mean scaled
    value per step, every feature, all accounts."""
    rows, names = _shap(spark, sf_dir)
    label = F.array(*[F.lit(n) for n in names])
    return X.summary_density(X.long_form(rows, "snapshot_id").withColumn("feature_name", label[F.col("feature_index")]))


# ---------------------------------------------------------------- streaming


def _stream_run(spark, sf_dir) -> dict:
    """All accounts as request files (4 files), scored by a streaming
    query with availableNow + maxFilesPerTrigger=1 (4 micro-batches)."""
    d = datasets(spark, sf_dir)
    cache = d.__dict__.setdefault("_stream", {})
    if not cache:
        base = scratch_path(spark, "stream")
        req = (_requests(spark, sf_dir)
               .withColumn("request_id", F.concat(F.lit("r"), F.col("snapshot_id").cast("string")))
               .select(*REQUEST_SCHEMA.fieldNames()))
        req.repartition(4, "request_id").write.parquet(f"{base}/requests")
        q = ST.start(spark, d.model("rf"), f"{base}/requests", REQUEST_SCHEMA, f"{base}/log",
                     f"{base}/summary", f"{base}/quarantine", f"{base}/checkpoint")
        q.awaitTermination()
        cache.update(log=f"{base}/log", summary=f"{base}/summary")
    return cache


@query("stream_scoring_log")
def stream_scoring_log(spark, sf_dir) -> DataFrame:
    """Prediction log written by the streaming scorer (one partition per batch)."""
    return ST.read_log(spark, _stream_run(spark, sf_dir)["log"]).select(*ST.LOG_COLUMNS, "batch_id")


@query("stream_batch_check", W(
    "SELECT COUNT(*) AS n_log, COUNT(*) AS n_ids, CAST(0 AS BIGINT) AS n_different FROM "
    f"(SELECT {_violations_sql()} AS v FROM (SELECT *, {_REQ_MODE} AS mode FROM vw) r) t WHERE v = ''"))
def stream_batch_check(spark, sf_dir) -> DataFrame:
    """Rows and distinct ids of the streaming log, and rows that differ from
    the batch scores of the same requests or lack one."""
    log = ST.read_log(spark, _stream_run(spark, sf_dir)["log"])
    batch = score_batch(spark, sf_dir).select(
        F.concat(F.lit("r"), F.col("snapshot_id").cast("string")).alias("request_id"),
        F.col("churn_probability").alias("p"), F.col("churn_flag").alias("f"))
    same = F.coalesce((F.abs(F.col("p") - F.col("churn_probability")) < 1e-12)
                      & (F.col("f") == F.col("churn_flag")), F.lit(False))
    joined = log.join(batch, "request_id", "full")
    return joined.agg(F.count("id").alias("n_log"), F.countDistinct("id").alias("n_ids"),
                      F.count_if(~same).alias("n_different"))


@query("stream_monitoring_summary")
def stream_monitoring_summary(spark, sf_dir) -> DataFrame:
    """Last-1000 summary refreshed by the streaming scorer after each batch."""
    run = _stream_run(spark, sf_dir)
    return ST.read_summary(spark, run["summary"], run["log"])


@query("view_preview", W(f"SELECT {VIEW_SELECT}, snapshot_id FROM vw ORDER BY snapshot_id LIMIT 5"))
def view_preview(spark, sf_dir) -> DataFrame:
    """head(5) of the view under a total order (the limit is the feature)."""
    v = datasets(spark, sf_dir).view_with(("customer", "contract", "services"),
                                          keep_snapshot_id=True)
    return v.orderBy("snapshot_id").limit(5)


@query("stream_log_summary", "WITH " + LOG + "\nSELECT churn_flag, "
       "CAST(SUM(CAST(churn_probability AS DECIMAL(38,18))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) "
       "AS avg_probability, COUNT(*) AS count FROM plog2 GROUP BY churn_flag")
def stream_log_summary(spark, sf_dir) -> DataFrame:
    """The events-derived prediction log landed as 4 files and summarised by a
    stateful streaming aggregation (one micro-batch per file)."""
    from churnframe.streaming.monitoring import start_summary
    base = scratch_path(spark, "log_stream")
    log = datasets(spark, sf_dir).prediction_log
    log.repartitionByRange(4, "id").write.parquet(f"{base}/log")
    q = start_summary(spark, f"{base}/log", f"{base}/summary", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/summary")
