"""Second-order gradient boosting with histograms.

Each round grows one tree for the logistic loss.  A row has the gradient
``p - y`` and the hessian ``p (1 - p)``; a level is one Spark job that sums
both per (node, feature, bin), and a split's gain is

    (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) / 2

with leaf values ``-rate * G / (H + l2)``.  Every tree draws its own share of
the rows (a hash of the row and the tree) and one share of the columns.

Scale: features are cut once into at most ``bins`` bins and written as one
byte each; a task sums its rows into a dense array of nodes x features x bins
and hands on its cells, which a shuffle adds up; the driver gets the summed
cells of one level (at most 2^(depth-1) x features x bins, whatever the number
of rows) and the trees.  Margins are written with the rows every ``REFRESH``
rounds, so a row is scored by that many trees at most in a job.  Gradients are
added as whole numbers (2^-30 steps): the trees do not depend on how the rows
are spread, nor on a task that is run again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.session import materialize, release

REFRESH = 20
STEP = float(1 << 30)


@dataclass
class Tree:
    """Nodes by number: 1 is the root, 2n and 2n + 1 are the children of n.
    Rows with a bin of at most ``cut`` go left; ``feature`` is -1 at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    grad: np.ndarray
    hess: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 1 << (depth + 1)
        return cls(np.full(n, -1), np.zeros(n, np.int64), *[np.zeros(n) for _ in range(4)])

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """Node that each row of ``bins`` (rows x features) ends in."""
        node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(int(math.log2(len(self.feature))) - 1):
            f = self.feature[node]
            right = bins[rows, np.maximum(f, 0)] > self.cut[node]
            node = np.where(f >= 0, 2 * node + right, node)
        return node

    def score(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.leaf_of(bins)]


@dataclass
class BoostedTrees:
    """``cuts``: ascending limits of each feature; a value's bin is the number
    of limits below it."""

    cuts: list
    trees: list = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(self.cuts)], 1).astype(np.uint8)

    def probability(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        margin = sum((t.score(b) for t in self.trees), np.zeros(len(x)))
        return 1.0 / (1.0 + np.exp(-margin))


def quantile_cuts(x: DataFrame, n_features: int, bins: int) -> list:
    """Limits between about equally full bins, from one approximate pass."""
    cols = x.select(*[F.col("x")[i].alias(f"f{i}") for i in range(n_features)])
    probs = [k / bins for k in range(1, bins)]
    cuts = cols.approxQuantile(cols.columns, probs, 1.0 / (4 * bins))
    tops = cols.agg(*[F.max(c) for c in cols.columns]).first()
    return [np.array(sorted({v for v in c if top is not None and v < top})) for c, top in zip(cuts, tops)]


def _in_sample(ids: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (ids.astype(np.uint64) ^ np.uint64(seed * 1_000_003 + tree)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(11)).astype(np.float64) < share * float(1 << 53)


def matrix(batch: pa.RecordBatch, n_features: int) -> np.ndarray:
    """Bins of a batch (rows x features), without a copy."""
    column = batch.column("bins")
    if not len(column):
        return np.zeros((0, n_features), np.uint8)
    at = np.frombuffer(column.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.uint8, len(column) * n_features, at).reshape(len(column), n_features)


def _margin(batch: pa.RecordBatch, bins: np.ndarray, trees: list) -> np.ndarray:
    m = batch.column("margin").to_numpy(zero_copy_only=False).copy()
    for t in trees:
        m += t.score(bins)
    return m


def level_cells(rows: DataFrame, tree: Tree, recent: list, level: int, columns: np.ndarray, n_features: int, width: int,
                number: int, seed: int, row_share: float) -> pa.Table:
    """Summed gradient, hessian and rows of each (node, feature, bin) of one
    level; features are numbered within ``columns``."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, recent, columns))

    def run(batches):
        tree, recent, columns = shared.value
        first, k = 1 << level, len(columns)
        g, h, n = (np.zeros((1 << level) * k * width, np.int64) for _ in range(3))
        for b in batches:
            bins = matrix(b, n_features)
            on = _in_sample(b.column("id").to_numpy(), number, seed, row_share)
            node = tree.leaf_of(bins)
            on &= node >= first
            p = 1.0 / (1.0 + np.exp(-_margin(b, bins, recent)))
            y = b.column("label").to_numpy()
            grad, hess = np.rint((p - y) * STEP)[on], np.rint(p * (1 - p) * STEP)[on]
            cell = (((node[on] - first) * k)[:, None] + np.arange(k)) * width + bins[on][:, columns]
            # below 2^53 per batch, so sums of doubles are exact
            for total, v in ((g, grad), (h, hess), (n, np.ones(len(grad)))):
                total += np.bincount(cell.ravel(), np.repeat(v, k), len(total)).astype(np.int64)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, g[at], h[at], n[at])], ["cell", "g", "h", "n"])
    return (rows.mapInArrow(run, "cell long, g long, h long, n long").groupBy("cell")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toArrow())


def _grow(tree: Tree, cells: pa.Table, level: int, columns: np.ndarray, cuts: list, width: int, l2: float,
          min_child: float, rate: float) -> None:
    """Best split of every node of the level; ties go to the smaller feature,
    then the smaller bin."""
    first, k = 1 << level, len(columns)
    g, h = np.zeros((2, first * k * width))
    at = cells.column("cell").to_numpy()
    g[at], h[at] = cells.column("g").to_numpy() / STEP, cells.column("h").to_numpy() / STEP
    g, h = (v.reshape(first, k, width).cumsum(2) for v in (g, h))
    allowed = np.arange(width) < np.array([len(cuts[c]) for c in columns])[:, None]
    for node in range(first):
        number = first + node
        if number > 1 and tree.feature[number // 2] < 0:
            continue
        gl, hl = g[node], h[node]
        gt, ht = gl[0, -1], hl[0, -1]
        tree.grad[number], tree.hess[number] = gt, ht
        gr, hr = gt - gl, ht - hl
        gain = (gl * gl / (hl + l2) + gr * gr / (hr + l2) - gt * gt / (ht + l2)) * 0.5
        gain = np.where(allowed & (hl >= min_child) & (hr >= min_child), gain, -np.inf)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        tree.value[number] = -rate * gt / (ht + l2)
        if gain[f, b] <= 0:
            continue
        tree.feature[number], tree.cut[number], tree.gain[number] = columns[f], b, gain[f, b]
        for child, gc, hc in ((2 * number, gl[f, b], hl[f, b]), (2 * number + 1, gr[f, b], hr[f, b])):
            tree.grad[child], tree.hess[child], tree.value[child] = gc, hc, -rate * gc / (hc + l2)


def binned_rows(plain: DataFrame, cuts: list, n_features: int, parts: int | None = None) -> DataFrame:
    """``plain`` (id, label, x) written once with a byte per feature and a
    margin of 0, in ``parts`` equal parts if that is given."""
    known = plain.sparkSession.sparkContext.broadcast(cuts)

    def binned(batches):
        m = BoostedTrees(known.value)
        for b in batches:
            v = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, n_features)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), pa.array([r.tobytes() for r in m.bins(v)], pa.binary()),
                 pa.array(np.zeros(b.num_rows))], ["id", "label", "bins", "margin"])
    rows = plain.mapInArrow(binned, "id long, label double, bins binary, margin double")
    return materialize(rows.repartition(parts) if parts else rows, "boosting_rows")


def fit_boosting(data: DataFrame, id_col: str, features_col: str = "features", label_col: str = "label", rounds: int = 300,
                 depth: int = 4, rate: float = 0.05, row_share: float = 0.8, column_share: float = 0.8, l2: float = 1.0,
                 min_child: float = 1.0, bins: int = 64, seed: int = 42, cuts: list | None = None) -> BoostedTrees:
    """Trees of second-order boosting; ``cuts`` sets the limits of each
    feature (at most 255), else they are quantiles."""
    kind = dict(data.dtypes)[features_col]
    x = F.col(features_col) if kind.startswith("array") else vector_to_array(features_col)
    plain = data.select(F.xxhash64(F.col(id_col)).alias("id"), F.col(label_col).cast("double").alias("label"), x.alias("x"))
    head = plain.first()
    if head is None:
        return BoostedTrees([])
    n_features = len(head["x"])
    model = BoostedTrees([np.asarray(c, float) for c in cuts] if cuts else quantile_cuts(plain, n_features, min(bins, 256)))
    width = max(len(c) for c in model.cuts) + 1
    rows = binned_rows(plain, model.cuts, n_features)
    recent: list = []
    for number in range(rounds):
        rng = np.random.default_rng([seed, number])
        columns = np.sort(rng.choice(n_features, max(1, round(column_share * n_features)), replace=False))
        tree = Tree.empty(depth)
        for level in range(depth):
            cells = level_cells(rows, tree, recent, level, columns, n_features, width, number, seed, row_share)
            _grow(tree, cells, level, columns, model.cuts, width, l2, min_child, rate)
            if not (tree.feature[1 << level:2 << level] >= 0).any():
                break
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == REFRESH and number + 1 < rounds:
            rows, recent = _with_margins(rows, recent, n_features), []
    release(rows)
    return model


def _with_margins(rows: DataFrame, recent: list, n_features: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(recent)

    def run(batches):
        for b in batches:
            m = _margin(b, matrix(b, n_features), shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(m)], b.schema.names)
    out = materialize(rows.mapInArrow(run, rows.schema), "boosting_rows")
    release(rows)
    return out


def score_boosting(model: BoostedTrees, df: DataFrame, features_col: str = "features",
                   out: str = "churn_probability") -> DataFrame:
    """``df`` with the probability of class 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def p(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probability(np.stack(x.to_numpy())) if len(x) else np.zeros(0))
    kind = dict(df.dtypes)[features_col]
    return df.withColumn(out, p(F.col(features_col) if kind.startswith("array") else vector_to_array(features_col)))


def tree_table(model: BoostedTrees, number: int, spark) -> DataFrame:
    """Nodes of one tree (at most 2^(depth+1)): node, feature and bin of the
    split (null at a leaf), gain, sums of gradient and hessian, leaf value."""
    t = model.trees[number]
    live = [1] + [c for n in range(1, len(t.feature) // 2) if t.feature[n] >= 0 for c in (2 * n, 2 * n + 1)]
    rows = [(n, *((int(t.feature[n]), int(t.cut[n]), float(t.gain[n])) if t.feature[n] >= 0 else (None, None, None)),
             float(t.grad[n]), float(t.hess[n]), float(t.value[n]) if t.feature[n] < 0 else None) for n in sorted(live)]
    return spark.createDataFrame(rows, "node int, feature int, bin int, gain double, grad double, hess double, value double")
