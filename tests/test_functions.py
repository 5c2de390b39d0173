"""Scalar expressions on the hand-built dirty frames (FIXTURES section 4)."""

import math

from churnframe.functions import (addon_count, avg_monthly_spend, churn_flag, clean_total_charges,
                                  int_default, safe_double, tenure_band_cut, tenure_band_sql,
                                  threshold_for_mode)
from churnframe.operators.validate import validate_requests

COERCE = ["12", " 12 ", "12.7", "1e3", "", " ", "Yes", "1d", "nan", None]


def test_safe_double_and_int_default(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(COERCE)], "i int, x string")
    rows = df.select("i", safe_double("x").alias("d"), int_default("x").alias("n"),
                     clean_total_charges("x").alias("t")).orderBy("i").collect()
    assert [r.d for r in rows] == [12.0, 12.0, 12.7, 1000.0] + [None] * 6
    assert [r.n for r in rows] == [12, 12, 12, 1000] + [0] * 6
    assert [r.t for r in rows] == [r.d for r in rows]


def test_tenure_bands(spark):
    vals = [-5, -1, 0, 12, 12.5, 13, 24, 25, 48, 49, 1200, 1201, None]
    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(vals)],
                               "i int, t double")
    rows = df.select("i", tenure_band_cut("t").alias("cut"),
                     tenure_band_sql("t").alias("sql")).orderBy("i").collect()
    assert [r.cut for r in rows] == ["nan", "nan", "0-12", "0-12", "13-24", "13-24", "13-24",
                                     "25-48", "25-48", "49+", "49+", "nan", "0-12"]
    assert [r.sql for r in rows] == ["49+", "49+", "0-12", "0-12", "49+", "13-24", "13-24",
                                     "25-48", "25-48", "49+", "49+", "49+", "49+"]
    cat = df.select("i", tenure_band_cut("t", fill_null=False, out_of_range=None).alias("c")) \
        .orderBy("i").collect()
    assert cat[-1].c is None and cat[0].c is None


def test_avg_monthly_spend(spark):
    rows = [(0, 0.0, 100.0), (1, -1.0, 100.0), (2, None, 100.0), (3, 10.0, None),
            (4, 10.0, 100.0), (5, 1.0, math.inf)]
    df = spark.createDataFrame(rows, "i int, t double, tot double")
    got = df.select("i", avg_monthly_spend("t", "tot").alias("a")).orderBy("i").collect()
    assert [r.a for r in got] == [0.0, 0.0, 0.0, None, 10.0, None]


def test_addon_count_skips_missing_columns(spark):
    df = spark.createDataFrame([("Yes", "No", "No internet service", None)],
                               "online_security string, online_backup string, "
                               "device_protection string, tech_support string")
    assert df.select(addon_count(df.columns).alias("n")).first().n == 1


def test_decision_policy_inclusive(spark):
    ps = [0.28, 0.48, 0.47999, 0.27999]
    df = spark.createDataFrame([(p, m) for p in ps for m in ("default", "aggressive")],
                               "p double, mode string")
    got = {(r.p, r.mode): r.flag for r in df.select(
        "p", "mode", churn_flag("p", threshold_for_mode("mode")).alias("flag")).collect()}
    assert got[(0.48, "default")] == 1 and got[(0.47999, "default")] == 0
    assert got[(0.28, "aggressive")] == 1 and got[(0.27999, "aggressive")] == 0
    assert all(got[(p, "aggressive")] >= got[(p, "default")] for p in ps)


def test_request_validation(spark):
    from churnframe.schema import REQUEST_SCHEMA
    base = {f.name: ("x" if f.dataType.simpleString() == "string" else 1) for f in
            REQUEST_SCHEMA.fields}
    base.update(senior_citizen=0, tenure_months=5, monthly_charges=95.2, total_charges=450.0,
                cltv=3500.0, mode="default")
    rows = [dict(base, request_id="a", senior_citizen=2), dict(base, request_id="b",
            tenure_months=-1), dict(base, request_id="c", mode="x"),
            dict(base, request_id="d", total_charges=None)]
    df = spark.createDataFrame([tuple(r[f.name] for f in REQUEST_SCHEMA.fields) for r in rows],
                               REQUEST_SCHEMA)
    got = {r.request_id: (r.is_valid, r.violations)
           for r in validate_requests(df).select("request_id", "is_valid", "violations").collect()}
    assert got["a"] == (False, "senior_citizen_range")
    assert got["b"] == (False, "tenure_months_negative")
    assert got["c"] == (False, "mode_invalid")
    assert got["d"] == (True, "")
