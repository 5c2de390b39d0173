"""Second-order boosting: exact splits, determinism, quality."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnframe.ml import boosting as B
from churnframe.ml import pipeline as MP
from churnframe.operators import evaluate as E


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 6)).round(2)
    z = 1.5 * x[:, 0] - x[:, 1] * x[:, 2] + np.abs(x[:, 3]) + rng.normal(scale=0.7, size=3000)
    rows = [(i, *map(float, r), float(v > 0.8)) for i, (r, v) in enumerate(zip(x, z))]
    cols = [f"c{k}" for k in range(6)]
    df = spark.createDataFrame(rows, "i long, " + ", ".join(f"{c} double" for c in cols) + ", label double")
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df).select("i", "features", "label")


def _auc(scored):
    return E.roc_auc(scored.select(F.col("churn_probability").alias("score"), F.col("label").cast("int").alias("label"))).first().auc


def test_not_below_first_order_boosting(spark, made):
    train, test = made.filter("i % 3 > 0"), made.filter("i % 3 = 0")
    own = B.fit_boosting(train, "i", rounds=24, rate=0.3)
    ref = GBTClassifier(featuresCol="features", labelCol="label", maxIter=24, maxDepth=4, stepSize=0.3, subsamplingRate=0.8,
                        featureSubsetStrategy="0.8", seed=1).fit(train)
    a, b = _auc(B.score_boosting(own, test)), _auc(MP.positive_probability(ref.transform(test)))
    # measured 0.9365 against 0.928 to 0.940 over three seeds of the other: equal within their spread
    assert a > 0.92 and a > b - 0.01, (a, b)


def test_trees_do_not_depend_on_the_partitioning(made):
    kw = dict(rounds=3, depth=3, cuts=[list(np.linspace(-2, 2, 9))] * 6)
    one, many = (B.fit_boosting(made.repartition(n), "i", **kw) for n in (1, 7))
    for t, u in zip(one.trees, many.trees):
        assert (t.feature == u.feature).all() and (t.cut == u.cut).all() and (t.value == u.value).all()


def test_margins_written_between_rounds_change_nothing(made, monkeypatch):
    kw = dict(rounds=5, depth=2, cuts=[list(np.linspace(-2, 2, 9))] * 6)
    plain = B.fit_boosting(made, "i", **kw)
    monkeypatch.setattr(B, "REFRESH", 2)
    again = B.fit_boosting(made, "i", **kw)
    assert all((t.feature == u.feature).all() and np.allclose(t.value, u.value) for t, u in zip(plain.trees, again.trees))


def test_tree_equals_brute_force(made):
    """Splits and leaf values of the second tree (margins not all zero)."""
    cuts = [list(np.linspace(-2, 2, 9))] * 6
    model = B.fit_boosting(made, "i", rounds=2, depth=2, row_share=1.0, column_share=1.0, cuts=cuts)
    rows = made.collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])
    bins = model.bins(x)
    m = model.trees[0].score(bins)
    p = 1 / (1 + np.exp(-m))
    g, h = p - y, p * (1 - p)
    t = model.trees[1]
    for node in (1, 2, 3):
        on = np.ones(len(y), bool)
        if node > 1:
            on = (bins[:, t.feature[1]] > t.cut[1]) == (node == 3)
        best = max(((g[on & (bins[:, f] <= b)].sum() ** 2 / (h[on & (bins[:, f] <= b)].sum() + 1)
                     + g[on & (bins[:, f] > b)].sum() ** 2 / (h[on & (bins[:, f] > b)].sum() + 1), f, b)
                    for f in range(6) for b in range(9)
                    if min(h[on & (bins[:, f] <= b)].sum(), h[on & (bins[:, f] > b)].sum()) >= 1))
        assert best[1:] == (t.feature[node], t.cut[node])
    leaf = t.leaf_of(bins)
    for n in range(4, 8):
        assert abs(t.value[n] + 0.05 * g[leaf == n].sum() / (h[leaf == n].sum() + 1)) < 1e-6


def test_edges(spark, made):
    assert B.fit_boosting(made.limit(0), "i", rounds=2).trees == []
    same = made.limit(50).withColumn("label", F.lit(1.0))
    model = B.fit_boosting(same, "i", rounds=2, depth=2)
    p = B.score_boosting(model, same).select("churn_probability").collect()
    assert len(p) == 50 and all(0.5 < r[0] < 1 for r in p)
