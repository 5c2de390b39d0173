"""ML stages: encoding, persistence, canonical request, SHAP, streaming."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnframe.ml import explain as X
from churnframe.ml import pipeline as MP
from churnframe.ml.explain import explain
from churnframe.plans.datasets import datasets
from churnframe.schema import REQUEST_SCHEMA


def test_one_hot_unknown_and_null_are_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    test = spark.createDataFrame([(0, "a"), (1, "zzz"), (2, None)], "i int, x string")
    si = StringIndexer(inputCol="x", outputCol="xi", stringOrderType="alphabetAsc",
                       handleInvalid="keep").fit(train)
    ohe = OneHotEncoder(inputCol="xi", outputCol="v", dropLast=True).fit(si.transform(train))
    got = ohe.transform(si.transform(test)).orderBy("i").select(vector_to_array("v").alias("a"))
    assert [r.a for r in got.collect()] == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


@pytest.fixture(scope="module")
def small_model(spark, sf):
    d = datasets(spark, sf)
    train, test = d.split
    clf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=3,
                                 maxDepth=3, seed=5, weightCol="weight")
    return MP.fit(train, clf), test


def test_persistence_round_trip(spark, small_model, tmp_path):
    model, test = small_model
    MP.save_model(model, str(tmp_path / "m"))
    back = MP.load_model(str(tmp_path / "m"))
    a = MP.positive_probability(model.transform(test)).select("snapshot_id", "churn_probability")
    b = MP.positive_probability(back.transform(test)).select(
        "snapshot_id", F.col("churn_probability").alias("p2"))
    j = a.join(b, "snapshot_id")
    assert j.count() == test.count()
    assert j.where(F.abs(F.col("churn_probability") - F.col("p2")) > 0).count() == 0


def test_canonical_request(spark, small_model):
    model, _ = small_model
    row = dict(request_id="r1", gender="Male", senior_citizen=0, partner="Yes", dependents="No",
               country="United States", state="CA", contract_type="Month-to-month",
               paperless_billing="Yes", payment_method="Electronic check", phone_service="Yes",
               multiple_lines="No", internet_service="Fiber optic", online_security="No",
               online_backup="No", device_protection="No", tech_support="No",
               streaming_tv="Yes", streaming_movies="Yes", tenure_months=5,
               monthly_charges=95.2, total_charges=450.0, cltv=3500.0, mode="default")
    df = spark.createDataFrame([tuple(row[f.name] for f in REQUEST_SCHEMA.fields)], REQUEST_SCHEMA)
    out = MP.score(model, df)
    r = out.select("avg_monthly_spend", "tenure_band", "addon_count", "threshold",
                   vector_to_array("cat__country").alias("cc"),
                   vector_to_array("cat__state").alias("cs"), "churn_probability").first()
    assert (r.avg_monthly_spend, r.tenure_band, r.addon_count) == (90.0, "0-12", 2)
    assert r.threshold == 0.48 and 0.0 <= r.churn_probability <= 1.0
    assert sum(r.cc) == 0.0 and sum(r.cs) == 0.0          # unknown categories -> zeros


def _tree_expectation(nodes, nid, x, subset):
    node = nodes[nid]
    if node["leftChild"] < 0:
        s = node["impurityStats"]
        return s[1] / sum(s)
    f = node["featureIndex"]
    thr = node["leftCategoriesOrThreshold"]
    left, right = node["leftChild"], node["rightChild"]
    if f in subset:
        go_left = (x[f] in thr) if node["numCategories"] > 0 else x[f] <= thr[0]
        return _tree_expectation(nodes, left if go_left else right, x, subset)
    c = sum(node["impurityStats"])
    cl, cr = sum(nodes[left]["impurityStats"]), sum(nodes[right]["impurityStats"])
    return (cl * _tree_expectation(nodes, left, x, subset)
            + cr * _tree_expectation(nodes, right, x, subset)) / c


def test_shap_matches_brute_force(spark, small_model):
    model, test = small_model
    rf = model.stages[-1]
    feats = model.transform(test)
    rows = feats.select("snapshot_id", vector_to_array("features").alias("x")).limit(5).collect()
    sh = explain(rf, feats, "snapshot_id").collect()
    phi = {(r.snapshot_id, r.feature_index): r.phi for r in sh}
    rf.write().overwrite().save(spark.conf.get("spark.checkpoint.dir") + "/bf_forest")
    data = spark.read.parquet(spark.conf.get("spark.checkpoint.dir") + "/bf_forest/data").select(
        "treeID", "nodeData.*", "nodeData.split.*").collect()
    trees = {}
    for r in data:
        trees.setdefault(r["treeID"], {})[r["id"]] = r
    for row in rows:
        x = row.x
        exp = np.zeros(len(x))
        for nodes in trees.values():
            used = sorted({n["featureIndex"] for n in nodes.values() if n["leftChild"] >= 0})
            d = len(used)
            for i in used:
                others = [u for u in used if u != i]
                for k in range(d):
                    w = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                    for s in itertools.combinations(others, k):
                        exp[i] += w * (_tree_expectation(nodes, 0, x, set(s) | {i})
                                       - _tree_expectation(nodes, 0, x, set(s)))
        exp /= len(trees)
        for i in range(len(x)):
            assert abs(phi[(row.snapshot_id, i)] - exp[i]) < 1e-9


def test_shap_additivity(spark, small_model):
    model, test = small_model
    feats = MP.positive_probability(model.transform(test))
    sh = explain(model.stages[-1], feats, "snapshot_id")
    chk = (sh.groupBy("snapshot_id").agg(F.sum("phi").alias("s"), F.first("base_value").alias("b"))
           .join(feats.select("snapshot_id", "churn_probability"), "snapshot_id"))
    err = chk.select(F.max(F.abs(F.col("s") + F.col("b") - F.col("churn_probability")))).first()[0]
    assert chk.count() == test.count() and err < 1e-9


def test_shap_tables_behind_the_plots(spark, small_model):
    model, test = small_model
    feats = MP.positive_probability(model.transform(test))
    names = MP.feature_names(feats)
    rows = X.explain_rows(model.stages[-1], feats, "snapshot_id", carry=["churn_probability"]).cache()
    check = X.additivity(rows, "churn_probability").first()
    assert (check.n_rows, check.n_not_additive) == (test.count(), 0)
    got = sorted(rows.select("snapshot_id", "x", "phi").collect())
    x, phi = (np.array([r[k] for r in got]) for k in ("x", "phi"))
    mean = {r.feature_name: r.mean_abs_shap for r in X.mean_abs(rows, names).collect()}
    assert all(abs(mean[n] - np.abs(phi[:, i]).mean()) < 1e-12 for i, n in enumerate(names))
    # companion feature: windows of rows in the order of the feature, ties by id
    i = names.index("num__tenure_months")
    order = np.lexsort(([r.snapshot_id for r in got], x[:, i]))
    size = max(min(len(order) // 10, 50), 1)
    exp = np.zeros(len(names))
    for s in range(0, len(order), size):
        w = order[s:s + size]
        for k in range(len(names)):
            if k != i and x[w, k].std() > 0 and phi[w, i].std() > 0:
                exp[k] += abs(np.corrcoef(phi[w, i], x[w, k])[0, 1])
    score = {r.feature_index: r.score for r in X.interaction_scores(rows, "snapshot_id", i, names).collect()}
    assert set(score) == set(range(len(names))) - {i}
    assert all(abs(score[k] - exp[k]) < 1e-6 for k in score)
    # density: every row in one step of its feature
    long = X.long_form(rows, "snapshot_id").withColumn("feature_name", F.col("feature_index").cast("string"))
    cells = X.summary_density(long, bins=20).collect()
    for k in (i, 0, len(names) - 1):
        p, v = phi[:, k], x[:, k]
        lo, hi = np.percentile(v, [5, 95])
        lo, hi = (v.min(), v.max()) if lo == hi else (lo, hi)
        scaled = (np.clip(v, lo, hi) - lo) / (hi - lo) if hi > lo else np.zeros(len(v))
        step = np.floor((p - p.min()) / (p.max() - p.min()) * 20) if p.max() > p.min() else np.zeros(len(p))
        mine = {r.bin: r for r in cells if r.feature_name == str(k)}
        assert sum(r.n for r in mine.values()) == len(p)
        for b, r in mine.items():
            assert r.n == (step == b).sum() and abs(r.mean_scaled_value - scaled[step == b].mean()) < 1e-9


def test_shap_of_repeated_features_and_equal_covers(spark):
    """A deep tree over two features tests both again and again on a path."""
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b), float((a > 3) ^ (b > 5) ^ (a > 7))) for i, (a, b) in enumerate(rng.integers(0, 12, (600, 2)))]
    df = spark.createDataFrame(rows, "i long, a double, b double, label double")
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    rf = RandomForestClassifier(numTrees=4, maxDepth=9, seed=2, featureSubsetStrategy="all").fit(vec)
    scored = MP.positive_probability(rf.transform(vec))
    out = X.explain_rows(rf, scored, "i", carry=["churn_probability"])
    r = X.additivity(out, "churn_probability").first()
    assert (r.n_rows, r.n_not_additive) == (600, 0)
    # with two features phi follows from the expectations of the four coalitions
    nodes = spark.read.parquet(_saved(spark, rf)).select("treeID", "nodeData.*", "nodeData.split.*").collect()
    trees = {}
    for n in nodes:
        trees.setdefault(n["treeID"], {})[n["id"]] = n
    for row in out.filter("i < 12").collect():
        e = lambda s: sum(_tree_expectation(t, 0, row.x, s) for t in trees.values()) / len(trees)  # noqa: B023,E731
        exp = [(e({k}) - e(set()) + e({0, 1}) - e({1 - k})) / 2 for k in (0, 1)]
        assert np.allclose(row.phi, exp, atol=1e-9)


def _saved(spark, rf):
    path = spark.conf.get("spark.checkpoint.dir") + "/two_features"
    rf.write().overwrite().save(path)
    return path + "/data"


def test_stream_equals_batch_with_invalid_requests(spark, sf):
    from churnframe.plans.catalog import QUERIES, _requests
    requests = _requests(spark, sf)
    _, rejected = MP.score_requests(datasets(spark, sf).model("rf"), requests)
    n_bad = rejected.count()
    assert n_bad > 0
    row = QUERIES["stream_batch_check"](spark, sf).first()
    assert row.n_log == row.n_ids == requests.count() - n_bad and row.n_different == 0
