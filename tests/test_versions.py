"""Stored star: one version per load, whatever happens in between."""

import os

import pytest
from pyspark.sql import functions as F

from churnframe.operators import star as S
from churnframe.plans.datasets import datasets
from churnframe.schema import FACT_SCHEMA
from churnframe.session import scratch_path
from churnframe.sources.snapshots import VersionConflict


def _counts(star):
    return tuple(df.count() for df in star)


@pytest.fixture
def parts(spark, sf):
    st = datasets(spark, sf).staging
    later = st.where("row_id % 2 = 1").withColumn("snapshot_date", F.lit("2026-02-28"))
    return st.where("row_id % 2 = 0"), later.withColumn("contract_type", F.concat(F.lit("new "), "contract_type"))


def test_failure_between_tables_leaves_the_old_star(spark, parts, monkeypatch):
    path = scratch_path(spark, "versions")
    old = _counts(S.load_and_write(parts[0], path))

    def die(*_):
        raise RuntimeError("executors lost")
    with monkeypatch.context() as m:
        m.setattr(S, "_write_fact", die)
        with pytest.raises(RuntimeError, match="lost"):
            S.merge_and_write(path, parts[1])
    group = S.stored_star(spark, path)
    assert group.versions() == [1] and _counts(S.read_star(spark, path)) == old
    # dimension files of the dead load are there, and in no version
    assert len(os.listdir(f"{path}/dim_contract")) == 2
    star = S.merge_and_write(path, parts[1])
    assert S.dq_duplicate_keys(star).count() == 0
    assert all(r.orphan_rows == 0 for r in S.dq_orphans(star).collect())
    twice = S.merge_and_write(path, parts[1])
    assert _counts(twice) == _counts(star) and star.fact.count() == parts[0].count() + parts[1].count()


def test_two_loads_at_once_cannot_both_win(spark, parts):
    path = scratch_path(spark, "versions")
    S.load_and_write(parts[0], path)
    group = S.stored_star(spark, path)
    before, tables = group.manifest()
    S.merge_and_write(path, parts[1])
    with pytest.raises(VersionConflict):
        group.publish(before, tables)
    assert group.versions() == [1, 2] and not [f for f in os.listdir(f"{path}/_versions") if f.startswith(".draft")]


def test_a_frame_read_earlier_keeps_its_rows(spark, parts):
    path = scratch_path(spark, "versions")
    first = S.load_and_write(parts[0], path)
    before = _counts(first)
    S.merge_and_write(path, parts[0].limit(3).withColumn("row_id", F.col("row_id") + 10 ** 9))
    assert _counts(first) == before and S.read_star(spark, path).fact.count() == 3
    assert _counts(S.read_star(spark, path, 1)) == before


def test_vacuum_and_compact(spark, parts):
    path = scratch_path(spark, "versions")
    S.load_and_write(parts[0], path)
    star = S.merge_and_write(path, parts[1])
    group, before = S.stored_star(spark, path), _counts(star)
    keys = {r.contract_key for r in star.dim_contract.collect()}
    assert len(group.manifest()[1]["dim_contract"]) == 2
    assert group.compact("dim_contract") == 3 and len(group.manifest()[1]["dim_contract"]) == 1
    assert group.vacuum(older_than_hours=1) == []  # a load may still be at work
    gone = group.vacuum(older_than_hours=-1)
    assert len(gone) == 2 and all(g.startswith("dim_contract/") for g in gone) and group.versions() == [3]
    now = S.read_star(spark, path)
    assert _counts(now) == before and {r.contract_key for r in now.dim_contract.collect()} == keys


def test_types_empty_loads_and_missing_dates(spark, parts):
    path = scratch_path(spark, "versions")
    assert _counts(S.read_star(spark, path)) == (0, 0, 0, 0)
    star = S.load_and_write(parts[0].limit(0), path)
    assert _counts(star) == (0, 0, 0, 0) and star.fact.schema == FACT_SCHEMA
    odd = parts[0].limit(5).withColumn("snapshot_date", F.when(F.col("row_id") % 4 > 0, F.lit("2026 a/b=c")))
    star = S.merge_and_write(path, odd)
    want = {r[0] for r in odd.select("snapshot_date").distinct().collect()}
    assert {r[0] for r in star.fact.select("snapshot_date").distinct().collect()} == want
    assert star.fact.schema == FACT_SCHEMA and star.fact.count() == 5
    one = star.fact.where("snapshot_date = '2026-01-28'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in one and "snapshot_date" in one.split("PartitionFilters: [")[1].split("]")[0]
