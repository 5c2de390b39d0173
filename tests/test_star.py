"""Load semantics: contract, first-wins, merges, dropped rows, rerun no-op."""

import pytest

from churnframe.operators import star as S
from churnframe.schema import REQUIRED_HEADERS
from churnframe.sources.raw import read_raw, require_columns


def _raw(spark, rows):
    """rows: list of dicts overriding a clean raw row."""
    base = {h: "x" for h in REQUIRED_HEADERS}
    base.update({"CustomerID": "C1", "Senior Citizen": "0", "Tenure Months": "5",
                 "Monthly Charges": "10.5", "Total Charges": "52.5", "CLTV": "3000",
                 "Churn Label": "No"})
    data = []
    for i, r in enumerate(rows):
        d = dict(base, **r)
        data.append(tuple([i + 1] + [d[h] for h in REQUIRED_HEADERS]))
    schema = "row_id long, " + ", ".join(f"`{h}` string" for h in REQUIRED_HEADERS)
    return spark.createDataFrame(data, schema)


def test_required_columns_listed_together(spark):
    df = _raw(spark, [{}]).drop("Gender", "CLTV")
    with pytest.raises(ValueError, match="Gender.*CLTV"):
        require_columns(df)


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_raw(spark, str(tmp_path / "nope.csv"))


def test_csv_extract_round_trip(spark, tmp_path):
    raw = _raw(spark, [{}, {"CustomerID": "C2", "Total Charges": " "}])
    path = str(tmp_path / "extract")
    raw.coalesce(1).write.option("header", True).csv(path)
    back = read_raw(spark, path)
    st = S.stage(back).orderBy("row_id").collect()
    assert [r.total_charges for r in st] == [52.5, None]
    assert st[0].tenure_months == 5 and st[0].snapshot_date == "2026-01-28"


def test_first_row_wins_and_conflict(spark):
    raw = _raw(spark, [{"Gender": "Male"}, {"Gender": "Female"}])
    star = S.load_star(S.stage(raw), materialize_result=False)
    dims = star.dim_customer.collect()
    assert len(dims) == 1 and dims[0].gender == "Male" and dims[0].customer_key == 1
    assert star.fact.count() == 2


def test_load_twice_is_noop(spark):
    st = S.stage(_raw(spark, [{}, {"CustomerID": "C2", "Contract": "y"}]))
    star = S.load_star(st, materialize_result=False)
    again = S.merge_star(star, st)
    assert again.dim_customer.count() == star.dim_customer.count() == 2
    assert again.dim_contract.count() == star.dim_contract.count() == 2
    assert again.dim_services.count() == 1
    assert again.fact.count() == 2


def test_merge_appends_new_keys_after_max(spark):
    st1 = S.stage(_raw(spark, [{"CustomerID": "C1"}, {"CustomerID": "C2"}]))
    st2 = S.stage(_raw(spark, [{"CustomerID": "C2"}, {"CustomerID": "C3"}]))
    merged = S.merge_dimension(S.build_dim_customer(st1), S.build_dim_customer(st2),
                               ["customer_id"], "customer_key")
    got = {r.customer_id: r.customer_key for r in merged.collect()}
    assert got == {"C1": 1, "C2": 2, "C3": 2 + 2}


def test_null_natural_key_dropped_and_reported(spark):
    st = S.stage(_raw(spark, [{}, {"Streaming TV": None}]))
    star = S.load_star(st, materialize_result=False)
    assert star.fact.count() == 1
    rep = S.fact_dropped_rows(st, star).collect()
    assert [(r.row_id, r.reason) for r in rep] == [(2, "null services key")]


def test_dense_surrogate_keys(spark):
    st = S.stage(_raw(spark, [{"CustomerID": c} for c in ["C9", "C1", "C9", "C5"]]))
    d = S.dense_keys(S.build_dim_customer(st), "customer_key").collect()
    assert sorted((r.customer_id, r.dense_key) for r in d) == [("C1", 2), ("C5", 3), ("C9", 1)]
