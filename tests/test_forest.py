"""Forest with balanced bootstraps: draws, weights, exact splits, quality."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnframe.ml import forest as RF
from churnframe.ml import pipeline as MP
from churnframe.operators import evaluate as E
from churnframe.operators.split import with_class_weights

CUTS = [list(np.linspace(-2, 2, 9))] * 6


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 6)).round(2)
    z = 1.5 * x[:, 0] - x[:, 1] * x[:, 2] + np.abs(x[:, 3]) + rng.normal(scale=0.7, size=3000)
    rows = [(i, *map(float, r), float(v > 2.0)) for i, (r, v) in enumerate(zip(x, z))]
    cols = [f"c{k}" for k in range(6)]
    df = spark.createDataFrame(rows, "i long, " + ", ".join(f"{c} double" for c in cols) + ", label double")
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df).select("i", "features", "label")


def _arrays(df):
    rows = df.orderBy("i").collect()
    return (np.array([r.i for r in rows]), np.array([r.features.toArray() for r in rows]),
            np.array([r.label for r in rows]))


def test_draws_are_poisson_and_apart():
    n = np.stack([RF.bootstrap_counts(np.arange(100_000), t, 42) for t in range(12)]).astype(float)
    assert abs(n.mean() - 1) < 0.01 and abs(n.var() - 1) < 0.02
    assert abs((n == 0).mean() - np.exp(-1)) < 0.005
    other = np.corrcoef(n) - np.eye(12)
    assert np.abs(other).max() < 0.02
    along = [np.corrcoef(n[0, k:], n[0, :-k])[0, 1] for k in (1, 2, 3, 7)]
    assert np.abs(along).max() < 0.02


def test_weights_of_each_bootstrap(made):
    ids, _, y = _arrays(made)
    got = {(r.tree, r.label): (r.n, r.weight) for r in RF.class_weights(made.repartition(5), "i", n_trees=7).collect()}
    assert len(got) == 14 and len({v for v in got.values()}) > 7
    for t in range(7):
        c = RF.bootstrap_counts(ids, t, 42)
        for k in (0, 1):
            assert got[t, k] == (c[y == k].sum(), c.sum() / (2 * c[y == k].sum()))


def test_tree_equals_brute_force(made):
    """Splits, leaf values and random columns of one tree, row by row."""
    model = RF.fit_forest(made, "i", n_trees=4, depth=3, cuts=CUTS, seed=5)
    ids, x, y = _arrays(made)
    t, number = model.trees[3], 3
    bins = np.array([[sum(v > c for c in CUTS[0]) for v in row] for row in x])
    times = RF.bootstrap_counts(ids, number, 5)
    w = times * np.array([times.sum() / (2 * times[y == k].sum()) for k in (0, 1)])[y.astype(int)]

    def gini(on):
        p = (w * y)[on].sum() / max(w[on].sum(), 1e-12)
        return w[on].sum() * 2 * p * (1 - p)
    seen = 0

    def walk(node, on, level):
        nonlocal seen
        leaf, options = t.feature[node] < 0, []
        if level < 3 and (on & (times > 0)).sum() >= 40 and gini(on) > 1e-9:
            columns = np.random.default_rng([5, number, node]).choice(6, 2, replace=False)
            options = [(gini(on) - gini(on & (bins[:, f] <= b)) - gini(on & (bins[:, f] > b)), int(f), b)
                       for f in columns for b in range(9)
                       if min((on & (times > 0) & (bins[:, f] <= b)).sum(), (on & (times > 0) & (bins[:, f] > b)).sum()) >= 20]
        if options:
            gain, f, b = max(options)
            assert not leaf and (f, b) == (t.feature[node], t.cut[node]) and abs(gain - t.gain[node]) < 1e-6
            seen += 1
            walk(2 * node, on & (bins[:, f] <= b), level + 1)
            walk(2 * node + 1, on & (bins[:, f] > b), level + 1)
        else:
            assert leaf and abs(t.value[node] - (w * y)[on].sum() / w[on].sum()) < 1e-9
    walk(1, np.ones(len(y), bool), 0)
    assert seen > 3


def test_trees_do_not_depend_on_partitions_nor_jobs(made, monkeypatch):
    kw = dict(n_trees=6, depth=4, cuts=CUTS)
    one = RF.fit_forest(made.repartition(1), "i", **kw)
    monkeypatch.setattr(RF, "CELLS", 100)
    many = RF.fit_forest(made.repartition(7), "i", **kw)
    for t, u in zip(one.trees, many.trees):
        assert (t.feature == u.feature).all() and (t.cut == u.cut).all() and (t.value == u.value).all()


def test_not_below_a_forest_with_one_weight(made):
    train, test = made.filter("i % 3 > 0"), made.filter("i % 3 = 0")

    def auc(scored):
        return E.roc_auc(scored.select(F.col("churn_probability").alias("score"), F.col("label").cast("int").alias("label"))).first().auc
    own = RF.score_forest(RF.fit_forest(train, "i", n_trees=40, depth=8), test)
    ref = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=40, maxDepth=8, minInstancesPerNode=20,
                                 featureSubsetStrategy="sqrt", seed=1, weightCol="weight").fit(with_class_weights(train, "label"))
    a, b = auc(own), auc(MP.positive_probability(ref.transform(test)))
    assert a > 0.88 and a > b - 0.01, (a, b)
    # balanced: the rarer class is found at 0.5
    hit = own.filter("label = 1").agg(F.avg((F.col("churn_probability") >= 0.5).cast("int"))).first()[0]
    assert hit > 0.7, hit


def test_importances_add_up(spark, made):
    model = RF.fit_forest(made, "i", n_trees=5, depth=4)
    rows = RF.importances(model, [f"c{k}" for k in range(6)], spark).collect()
    assert abs(sum(r.importance for r in rows) - 1) < 1e-9
    assert max(rows, key=lambda r: r.importance).feature == "c0"


def test_edges(spark, made):
    assert RF.fit_forest(made.limit(0), "i", n_trees=2).trees == []
    none = RF.score_forest(RF.fit_forest(made.limit(0), "i", n_trees=2), made.limit(3)).collect()
    assert [r.churn_probability for r in none] == [0.5] * 3
    same = made.limit(50).withColumn("label", F.lit(1.0))
    p = RF.score_forest(RF.fit_forest(same, "i", n_trees=2, depth=2), same).collect()
    assert {r.churn_probability for r in p} == {1.0}
    gaps = made.withColumn("label", F.when(F.col("i") % 2 == 0, F.col("label")))
    a, b = RF.fit_forest(gaps, "i", n_trees=2, depth=2, cuts=CUTS), RF.fit_forest(made.filter("i % 2 = 0"), "i", n_trees=2, depth=2, cuts=CUTS)
    assert all((t.feature == u.feature).all() and (t.value == u.value).all() for t, u in zip(a.trees, b.trees))
    twice = RF.fit_forest(made.limit(1), "i", n_trees=30, depth=2)
    assert 0 < len(twice.trees) < 30  # a bootstrap without a row gives no tree


def test_cells_are_added_in_one_pass_per_tree(monkeypatch):
    """The three sums of a cell come from one count over the rows, and equal a
    loop over rows."""
    rng = np.random.default_rng(7)
    n, k, width, seed = 2000, 2, 4, 42
    bins, ids, y = rng.integers(0, width, (n, 5)).astype(np.uint8), np.arange(n), rng.integers(0, 2, n).astype(float)
    tree = RF.Tree.empty(3)
    tree.feature[1], tree.cut[1], tree.feature[2], tree.cut[2] = 3, 1, 0, 2
    slots = np.full(16, -1)
    slots[[4, 5]] = [0, 1]
    columns = np.array([[1, 4], [2, 0]])
    work = [(t, tree, slots, columns) for t in range(3)]
    calls, count = [], np.bincount
    monkeypatch.setattr(RF.np, "bincount", lambda *a: calls.append(1) or count(*a))
    total = np.zeros((3, 3 * 2 * k * width), np.int64)
    RF._add_cells(total, work, bins, ids, y, k, width, seed, 2)
    assert len(calls) == len(work)
    exp = np.zeros_like(total)
    for t in range(3):
        for i, c in enumerate(RF.bootstrap_counts(ids, t, seed)):
            slot = slots[tree.leaf_of(bins[i:i + 1])[0]]
            if c and slot >= 0:
                for j, f in enumerate(columns[slot]):
                    cell = ((t * 2 + slot) * k + j) * width + bins[i, f]
                    exp[int(y[i]), cell] += c
                    exp[2, cell] += 1
    assert (total == exp).all() and total[2].any()
