"""Replay of a batch that failed, commits, and the model store."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from churnframe.ml import pipeline as MP
from churnframe.ml.store import ModelStore, fingerprint, parameters
from churnframe.operators.monitoring import monitoring_summary
from churnframe.plans.datasets import datasets
from churnframe.schema import REQUEST_SCHEMA
from churnframe.streaming import scoring as ST


def _forest(**kw):
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=2, maxDepth=2, seed=5, **kw)


@pytest.fixture(scope="module")
def model(spark, sf):
    return MP.fit(datasets(spark, sf).split[0], _forest(), weighted=False)


@pytest.fixture(scope="module")
def requests(spark, sf):
    """Requests without ids of their own, so that the batch must draw them."""
    from churnframe.plans.catalog import _requests
    r = _requests(spark, sf).withColumn("request_id", F.lit(None).cast("string"))
    return r.select("snapshot_id", *REQUEST_SCHEMA.fieldNames())


def _run(spark, model, df, batch, base):
    ST.log_batch(spark, model, df, batch, f"{base}/log", f"{base}/summary", f"{base}/quarantine", window=50)


def test_replay_after_a_failure_keeps_ids_stamps_and_rows(spark, model, requests, tmp_path, monkeypatch):
    base = str(tmp_path)
    part = requests.filter("snapshot_id % 9 < 3")
    _run(spark, model, requests.filter("snapshot_id % 9 = 4"), 0, base)
    before = {tuple(r) for r in ST.read_log(spark, f"{base}/log").collect()}
    with monkeypatch.context() as m:
        m.setattr(ST, "monitoring_summary", lambda *a: (_ for _ in ()).throw(RuntimeError("executor lost")))
        with pytest.raises(RuntimeError):
            _run(spark, model, part, 1, base)
    # scored and written, not committed: not seen by readers of the log or the summary
    half = {tuple(r) for r in spark.read.parquet(f"{base}/log/batch_id=1").select(*ST.LOG_COLUMNS).collect()}
    assert half and {tuple(r) for r in ST.read_log(spark, f"{base}/log").collect()} == before
    ST.read_summary(spark, f"{base}/summary", f"{base}/log").collect()
    _run(spark, model, part, 1, base)
    log = ST.read_log(spark, f"{base}/log")
    after = {tuple(r) for r in log.filter("batch_id = 1").select(*ST.LOG_COLUMNS).collect()}
    assert after == half
    _run(spark, model, part, 1, base)  # once more, after the commit
    assert {tuple(r) for r in ST.read_log(spark, f"{base}/log").filter("batch_id = 1").select(*ST.LOG_COLUMNS).collect()} == half
    log = ST.read_log(spark, f"{base}/log")  # files were written anew
    got = {tuple(r) for r in ST.read_summary(spark, f"{base}/summary", f"{base}/log").collect()}
    assert got == {tuple(r) for r in monitoring_summary(log, 50).collect()}


def test_summary_after_each_batch_equals_the_batch_summary(spark, model, requests, tmp_path):
    base = str(tmp_path)
    for batch in range(3):
        _run(spark, model, requests.filter(F.col("snapshot_id") % 40 == batch), batch, base)
        log = ST.read_log(spark, f"{base}/log")
        got = {tuple(r) for r in ST.read_summary(spark, f"{base}/summary", f"{base}/log").collect()}
        assert got == {tuple(r) for r in monitoring_summary(log, 50).collect()}
    assert log.select("id").distinct().count() == log.count()


def test_reading_before_the_first_commit(spark, tmp_path):
    assert ST.read_log(spark, f"{tmp_path}/log").count() == 0
    with pytest.raises(ValueError):
        ST.read_summary(spark, f"{tmp_path}/summary", f"{tmp_path}/log")


def test_second_session_does_not_fit(spark, sf, tmp_path):
    train, test = datasets(spark, sf).split
    fits = []

    def fit():
        fits.append(1)
        return MP.fit(train, _forest(), weighted=False)
    key = ("rf", parameters(_forest()), fingerprint(train.select("snapshot_id", "label", "tenure_months")))
    one = ModelStore(spark, str(tmp_path / "m")).load_or_fit(*key, fit)
    two = ModelStore(spark, str(tmp_path / "m")).load_or_fit(*key, fit)
    assert len(fits) == 1 and len(ModelStore(spark, str(tmp_path / "m")).versions()) == 1
    a, b = ({(r.snapshot_id, r.churn_probability) for r in MP.positive_probability(m.transform(test)).select(
        "snapshot_id", "churn_probability").collect()} for m in (one, two))
    assert a == b
    ModelStore(spark, str(tmp_path / "m")).load_or_fit("rf", parameters(_forest(minInstancesPerNode=7)), key[2], fit)
    assert len(fits) == 2


def test_a_lost_race_uses_the_model_that_is_there(spark, model, tmp_path):
    store = ModelStore(spark, str(tmp_path / "m"))

    def fit():
        if not store.has("rf", {}, "x"):
            store.load_or_fit("rf", {}, "x", lambda: model)  # the other session ends first
        return model
    assert len(store.load_or_fit("rf", {}, "x", fit).stages) == len(model.stages)
    assert len(store.versions()) == 1


def test_fingerprint_is_of_rows_as_a_bag(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k long, v string")
    assert fingerprint(df) == fingerprint(df.repartition(3).orderBy("v").select("v", "k"))
    assert len({fingerprint(d) for d in (df, df.distinct(), df.limit(0), df.withColumn("v", F.lit("b")))}) == 4
