"""Independent DuckDB SQL for every SQL-expressible query.

The chain rebuilds, in plain SQL over the supplied tables, the subscriber
fixture, its dirty raw extract, the cleaned staging rows, the star schema and
the training view; each oracle query is ``WITH <chain> SELECT ...``.
"""

from __future__ import annotations

from churnframe.schema import (ADDON_COLUMNS, CONTRACT_COLS, CUSTOMER_ATTRS, HEADER_TO_COLUMN,
                               SERVICE_COLS, SNAPSHOT_DATE, TENURE_BAND_LABELS,
                               TENURE_CUT_EDGES, TENURE_SQL_BANDS, TENURE_SQL_OTHER)

NUM_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def _safe_double(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match(trim({x}), '{NUM_RE}') "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END)")


def _int_default(x: str) -> str:
    return f"COALESCE(TRY_CAST(trunc(COALESCE({_safe_double(x)}, 0.0)) AS INTEGER), 0)"


def _clean_total(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR trim({x}) = '' THEN NULL ELSE {_safe_double(x)} END)"


ADDON = list(ADDON_COLUMNS)
CONTRACT = list(CONTRACT_COLS)
SERVICES = list(SERVICE_COLS)
CUST = list(CUSTOMER_ATTRS)
HEADERS = list(HEADER_TO_COLUMN.items())
SNAPSHOT = f"'{SNAPSHOT_DATE}'"


def _addon_case(cond: str) -> str:
    return (f"CASE WHEN c_mktsegment = 'FURNITURE' THEN 'No internet service' "
            f"WHEN {cond} THEN 'Yes' ELSE 'No' END")


SUBSCRIBER = f"""
li AS (
  SELECT l_orderkey, COUNT(*) AS n_lines, MAX(l_discount) AS max_disc, MAX(l_tax) AS max_tax,
         MAX(l_quantity) AS max_qty,
         MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS any_r,
         MAX(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS any_a,
         MAX(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS any_o
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
         c.c_custkey, c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey, r.r_name,
         li.n_lines, li.max_disc, li.max_tax, li.max_qty, li.any_r, li.any_a, li.any_o,
         (2001 - year(o.o_orderdate)) * 12 + (8 - month(o.o_orderdate)) AS ten
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
subscriber AS (
  SELECT o_orderkey AS row_id,
    'C' || CAST(c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CAST(CASE WHEN c_acctbal > 8000 THEN 1 ELSE 0 END AS INTEGER) AS senior_citizen,
    CASE WHEN n_regionkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner,
    CASE WHEN c_custkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS dependents,
    r_name AS country, n_name AS state,
    CASE o_orderstatus WHEN 'F' THEN 'Month-to-month' WHEN 'O' THEN 'One year'
         ELSE 'Two year' END AS contract_type,
    CASE WHEN o_orderkey % 5 < 3 THEN 'Yes' ELSE 'No' END AS paperless_billing,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Electronic check'
         WHEN '2-HIGH' THEN 'Mailed check' WHEN '3-MEDIUM' THEN 'Bank transfer (automatic)'
         ELSE 'Credit card (automatic)' END AS payment_method,
    CASE WHEN o_orderkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS phone_service,
    CASE WHEN o_orderkey % 10 = 0 THEN 'No phone service'
         WHEN COALESCE(n_lines, 0) > 4 THEN 'Yes' ELSE 'No' END AS multiple_lines,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Fiber optic'
         WHEN c_mktsegment = 'FURNITURE' THEN 'No' ELSE 'DSL' END AS internet_service,
    {_addon_case('any_r = 1')} AS online_security,
    {_addon_case('any_a = 1')} AS online_backup,
    {_addon_case('any_o = 1')} AS device_protection,
    {_addon_case('max_disc > 0.08')} AS tech_support,
    {_addon_case('max_tax > 0.06')} AS streaming_tv,
    {_addon_case('max_qty > 40')} AS streaming_movies,
    CAST(ten AS INTEGER) AS tenure_months,
    o_totalprice / 4096 AS monthly_charges,
    CASE WHEN ten = 0 OR o_orderkey % 97 = 0 THEN NULL
         ELSE o_totalprice / 4096 * ten END AS total_charges,
    CAST(2000 + c_custkey % 4500 AS DOUBLE) AS cltv,
    CASE WHEN (o_orderkey * 7919) % 100 <
              (CASE o_orderstatus WHEN 'F' THEN 45 WHEN 'O' THEN 15 ELSE 5 END)
              + (CASE WHEN ten <= 12 THEN 20 ELSE 0 END)
         THEN 'Yes' ELSE 'No' END AS churn_label,
    {SNAPSHOT} AS snapshot_date
  FROM base)"""


def _raw_select() -> str:
    dirt = {
        "total_charges": "CASE WHEN total_charges IS NULL THEN ' ' "
                         "ELSE CAST(total_charges AS VARCHAR) END",
        "senior_citizen": "CASE WHEN row_id % 50 = 0 THEN 'Yes' "
                          "ELSE CAST(senior_citizen AS VARCHAR) END",
        "tenure_months": "CASE WHEN row_id % 101 = 0 THEN 'n/a' "
                         "ELSE CAST(tenure_months AS VARCHAR) END",
        "monthly_charges": "CASE WHEN row_id % 103 = 0 THEN 'abc' "
                           "ELSE CAST(monthly_charges AS VARCHAR) END",
    }
    cols = ["row_id"] + [f"{dirt.get(c, f'CAST({c} AS VARCHAR)')} AS \"{h}\""
                         for h, c in HEADERS]
    return ",\n    ".join(cols)


def _staging_select() -> str:
    coerce = {"senior_citizen": _int_default, "tenure_months": _int_default,
              "monthly_charges": _safe_double, "total_charges": _clean_total,
              "cltv": _safe_double}
    cols = ["row_id"]
    for h, c in HEADERS:
        f = coerce.get(c)
        cols.append(f"{f(chr(34) + h + chr(34)) if f else chr(34) + h + chr(34)} AS {c}")
    cols.append(f"{SNAPSHOT} AS snapshot_date")
    return ",\n    ".join(cols)


def _join_on(left: str, right: str, cols) -> str:
    return " AND ".join(f"{left}.{c} = {right}.{c}" for c in cols)


STAR = f"""
raw AS (
  SELECT {_raw_select()}
  FROM subscriber),
staging AS (
  SELECT {_staging_select()}
  FROM raw),
dim_customer AS (
  SELECT row_id AS customer_key, customer_id, {', '.join(CUST)}
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_id) AS rn
        FROM staging WHERE customer_id IS NOT NULL) t
  WHERE rn = 1
  UNION ALL
  SELECT MIN(row_id) AS customer_key, customer_id, {', '.join(CUST)}
  FROM staging WHERE customer_id IS NULL
  GROUP BY customer_id, {', '.join(CUST)}),
dim_contract AS (
  SELECT MIN(row_id) AS contract_key, {', '.join(CONTRACT)}
  FROM staging GROUP BY {', '.join(CONTRACT)}),
dim_services AS (
  SELECT MIN(row_id) AS services_key, {', '.join(SERVICES)}
  FROM staging GROUP BY {', '.join(SERVICES)}),
fact AS (
  SELECT s.row_id AS snapshot_id, dc.customer_key, k.contract_key, v.services_key,
         s.tenure_months, s.monthly_charges, s.total_charges, s.cltv, s.churn_label,
         s.snapshot_date
  FROM staging s
  JOIN dim_customer dc ON dc.customer_id = s.customer_id
  JOIN dim_contract k ON {_join_on('k', 's', CONTRACT)}
  JOIN dim_services v ON {_join_on('v', 's', SERVICES)}),
vw AS (
  SELECT dc.customer_id, {', '.join('dc.' + c for c in CUST)},
         {', '.join('k.' + c for c in CONTRACT)},
         {', '.join('v.' + c for c in SERVICES)},
         f.tenure_months, f.monthly_charges, f.total_charges, f.cltv,
         CASE WHEN f.churn_label = 'Yes' THEN 1 ELSE 0 END AS churn_target,
         f.snapshot_date, f.snapshot_id
  FROM fact f
  JOIN dim_customer dc ON dc.customer_key = f.customer_key
  JOIN dim_contract k ON k.contract_key = f.contract_key
  JOIN dim_services v ON v.services_key = f.services_key)"""

VIEW_COLS = (["customer_id"] + CUST + CONTRACT + SERVICES
             + ["tenure_months", "monthly_charges", "total_charges", "cltv",
                "churn_target", "snapshot_date"])


def with_chain(select: str, extra_ctes: str = "") -> str:
    chain = SUBSCRIBER + "," + STAR
    if extra_ctes:
        chain += ",\n" + extra_ctes
    return f"WITH {chain}\n{select}"


def addon_sum_sql(prefix: str = "") -> str:
    return " + ".join(f"(CASE WHEN {prefix}{c} = 'Yes' THEN 1 ELSE 0 END)" for c in ADDON)


def cut_band_sql(x: str, null_label: str | None = "'nan'", fill: bool = True) -> str:
    t = f"COALESCE(CAST({x} AS DOUBLE), 0.0)" if fill else f"CAST({x} AS DOUBLE)"
    other = null_label if null_label is not None else "NULL"
    edges = TENURE_CUT_EDGES
    arms = " ".join(f"WHEN {t} > {lo} AND {t} <= {hi} THEN '{lab}'"
                    for lo, hi, lab in zip(edges[:-1], edges[1:], TENURE_BAND_LABELS))
    return f"CASE {arms} ELSE {other} END"


def sql_band_sql(x: str) -> str:
    arms = " ".join(f"WHEN {x} BETWEEN {lo} AND {hi} THEN '{lab}'"
                    for lo, hi, lab in TENURE_SQL_BANDS)
    return f"CASE {arms} ELSE '{TENURE_SQL_OTHER}' END"


def avg_spend_sql(t: str = "tenure_months", total: str = "total_charges") -> str:
    return (f"CASE WHEN COALESCE(CAST({t} AS DOUBLE), 0.0) > 0 "
            f"THEN CAST({total} AS DOUBLE) / CAST({t} AS DOUBLE) ELSE 0.0 END")


def quantile_sql(src: str, value: str, probs, group: str | None = None,
                 where: str = "TRUE") -> str:
    """Exact quantiles by order statistics (row_number) with numpy's linear
    interpolation; one row per group with columns q0, q1, ... in ``probs``
    order.  ``group`` None -> a single row."""
    g = group or "0"
    parts = []
    for i, p in enumerate(probs):
        pos = f"(n - 1) * CAST({p} AS DOUBLE)"
        parts.append(
            f"MAX(CASE WHEN rn = CAST(floor({pos}) AS BIGINT) + 1 THEN v END) AS lo{i}, "
            f"MAX(CASE WHEN rn = CAST(ceil({pos}) AS BIGINT) + 1 THEN v END) AS hi{i}, "
            f"MAX({pos} - floor({pos})) AS t{i}")
    inner = (f"SELECT {g} AS g, CAST({value} AS DOUBLE) AS v, "
             f"row_number() OVER (PARTITION BY {g} ORDER BY CAST({value} AS DOUBLE)) AS rn, "
             f"COUNT(*) OVER (PARTITION BY {g}) AS n FROM {src} "
             f"WHERE {value} IS NOT NULL AND {where}")
    agg = f"SELECT g, {', '.join(parts)} FROM ({inner}) o GROUP BY g"
    outs = ", ".join(
        f"CASE WHEN t{i} >= 0.5 THEN hi{i} - (hi{i} - lo{i}) * (1.0 - t{i}) "
        f"ELSE lo{i} + (hi{i} - lo{i}) * t{i} END AS q{i}" for i in range(len(probs)))
    return f"SELECT g, {outs} FROM ({agg}) a"
