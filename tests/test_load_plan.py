"""The load's plan and its coercion: what is shuffled, sorted and computed."""

import re

from churnframe.functions.coerce import safe_double
from churnframe.operators.star import build_dim_customer, build_fact, small_dimensions
from churnframe.schema import CONTRACT_COLS, CUSTOMER_ATTRS, MEASURE_COLS, SERVICE_COLS

TEXT = CUSTOMER_ATTRS[:1] + CUSTOMER_ATTRS[2:] + CONTRACT_COLS + SERVICE_COLS


def _staging(spark, rows):
    """Rows of (row_id, customer_id, gender, contract_type)."""
    cols = ", ".join(f"'{c}' AS {c}" for c in TEXT if c not in ("gender", "contract_type"))
    nums = ", ".join(f"CAST(1 AS DOUBLE) AS {c}" for c in MEASURE_COLS)
    df = spark.createDataFrame(rows, "row_id long, customer_id string, gender string, contract_type string")
    return df.selectExpr("*", *[x.strip() for x in f"{cols}, {nums}".split(",")], "0 AS senior_citizen",
                         "'Yes' AS churn_label", "'2026-01-28' AS snapshot_date")


ROWS = [(5, "a", "m", "x"), (3, "a", "f", "x"), (3, "a", "e", None), (9, "b", None, "y"), (None, "b", "z", "y"),
        (7, "b", "z", "x"), (None, None, "m", "x"), (2, None, "m", "x"), (4, "c", None, "x"), (4, "c", "q", "y")]


def test_first_row_of_a_customer_wins(spark):
    """The least (row id, attributes), nulls first; rows without an id as distinct tuples."""
    got = {(r.customer_key, r.customer_id, r.gender) for r in build_dim_customer(_staging(spark, ROWS)).collect()}
    assert got == {(3, "a", "e"), (None, "b", "z"), (4, "c", None), (2, None, "m")}


def test_first_rows_are_found_by_hash(spark):
    plan = build_dim_customer(_staging(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    # rows with an id and rows without one
    assert len(re.findall(r"HashAggregate\(keys=\[customer_id#\d+, gender#\d+.*partial_min\(row_id", plan)) == 2


def test_text_of_small_dimensions_is_not_shuffled_to_customers(spark):
    st = _staging(spark, ROWS)
    dc, (dk, ds) = build_dim_customer(st), small_dimensions(st)
    fact = build_fact(st, dc, dk, ds)
    joins = [x for x in fact._jdf.queryExecution().analyzed().toString().split("\n") if "Join Inner" in x]
    assert "customer_id" in joins[0]
    got = [(r.snapshot_id, r.customer_key, r.contract_key, r.services_key) for r in fact.collect()]
    assert sorted(got, key=str) == sorted([(5, 3, 2, 2), (3, 3, 2, 2), (9, None, 4, 2), (None, None, 4, 2),
                                           (7, None, 2, 2), (4, 4, 2, 2), (4, 4, 4, 2)], key=str)


def test_a_number_is_parsed_once(spark):
    df = spark.createDataFrame([(v,) for v in (" 12.5\t", "1e999", "-1e999", "nan", "", None, "1d", "x")], "a string")
    out = df.select(safe_double("a").alias("v"))
    assert [r.v for r in out.collect()] == [12.5] + [None] * 7
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") <= 1
