"""Evaluators against brute force; split and weights."""

import numpy as np
import pandas as pd

from churnframe.operators.evaluate import classification_report, pr_curve, roc_auc
from churnframe.operators.split import class_weights, stratified_quotas, stratified_split


def _data(n=500, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) * 0.5 + y * 0.3, 2)     # ties on purpose
    return pd.DataFrame({"score": s, "label": y})


def test_pr_curve_brute_force(spark):
    pdf = _data()
    got = pr_curve(spark.createDataFrame(pdf)).toPandas().set_index("threshold")
    pos = pdf.label.sum()
    for t in np.unique(pdf.score):
        sel = pdf[pdf.score >= t]
        tp = sel.label.sum()
        assert abs(got.loc[t, "precision"] - tp / len(sel)) < 1e-12
        assert abs(got.loc[t, "recall"] - tp / pos) < 1e-12
    r = got.sort_index()["recall"].to_numpy()
    assert (np.diff(r) <= 1e-15).all()                  # recall non-increasing in threshold


def test_auc_brute_force(spark):
    pdf = _data()
    p = pdf[pdf.label == 1].score.to_numpy()
    q = pdf[pdf.label == 0].score.to_numpy()
    exp = ((p[:, None] > q[None, :]).sum() + 0.5 * (p[:, None] == q[None, :]).sum()) / (len(p) * len(q))
    got = roc_auc(spark.createDataFrame(pdf)).first().auc
    assert abs(got - exp) < 1e-12


def test_classification_report(spark):
    pdf = pd.DataFrame({"label": [1, 1, 0, 0, 0], "prediction": [1, 0, 1, 0, 0]})
    rep = {r.class_label: r for r in classification_report(spark.createDataFrame(pdf)).collect()}
    assert rep["1"].precision == 0.5 and rep["1"].recall == 0.5 and rep["1"].support == 2
    assert abs(rep["0"].precision - 2 / 3) < 1e-12 and rep["accuracy"].f1_score == 0.6


def test_quotas_and_split(spark):
    q = stratified_quotas({0: 11303, 1: 3697})
    assert sum(q.values()) == 15000 - 3000
    pdf = pd.DataFrame({"rid": range(1000), "y": [1 if i % 4 == 0 else 0 for i in range(1000)]})
    s = stratified_split(spark.createDataFrame(pdf), "y", "rid").toPandas()
    counts = s.groupby(["y", "split"]).size().to_dict()
    assert counts[(0, "test")] + counts[(1, "test")] == 200
    assert counts[(1, "test")] == 50
    s2 = stratified_split(spark.createDataFrame(pdf), "y", "rid").toPandas()
    assert (s.sort_values("rid").split.to_numpy() == s2.sort_values("rid").split.to_numpy()).all()


def test_balanced_weights(spark):
    pdf = pd.DataFrame({"y": [0] * 30 + [1] * 10})
    w = {r.y: r.weight for r in class_weights(spark.createDataFrame(pdf), "y").collect()}
    assert w == {0: 40 / (2 * 30), 1: 40 / (2 * 10)}
