"""Random forest with classes balanced in every bootstrap.

A tree's bootstrap gives each row a Poisson(1) count, a function of the row's
id, the tree and the seed, so no sample is stored and a task that is run again
draws the same one.  The weight of class c in a tree is

    (rows of the bootstrap) / (classes * rows of the bootstrap with class c)

and a node is split where 2ab/W (a, b: weights of the two classes, W their sum,
the Gini impurity times W) falls most; a leaf's value is b / W, the forest's
probability the mean over its trees.  A node looks at ``sqrt(features)`` random
features, and a leaf holds at least ``min_leaf`` different rows.

Scale: all trees grow together, level by level.  A job takes as many trees as
their open nodes x features x bins fit into ``CELLS``, a task adds its rows up
in a dense array of that size, a shuffle adds up the tasks, and the driver gets
the sums of one job, whatever the number of rows.  Counts are whole numbers:
the trees do not depend on how the rows are spread.

Defined results: rows with a null label take no part; a null id counts as id
0; an empty table gives a forest without trees (probability 0.5), one class
alone gives leaves without a split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnframe.ml.boosting import BoostedTrees, Tree, binned_rows, matrix, quantile_cuts
from churnframe.session import release

#: cells (node, feature, bin) of one job
CELLS = 1 << 20
#: rows added up together, so that their three sums fit into one double: a row
#: is drawn at most 10 times
PACK_ROWS, PACK_BITS = 32_000, 19
#: rows of a task at most
PART_ROWS = 1_000_000
#: rows whose bins stay in the cache
CACHE_ROWS = 8_000
#: hashes are below this prime; every product stays below 2^63
PRIME = (1 << 31) - 1
#: a row's count is the number of these limits that its hash reaches
LIMITS = [int(PRIME * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(10)]


def _mod_prime(x: np.ndarray) -> np.ndarray:
    """``x % PRIME`` of numbers that are not negative; a division by a constant
    is faster than a remainder."""
    return x - x // PRIME * PRIME


def _hash_base(ids: np.ndarray, seed: int) -> np.ndarray:
    """The part of a row's hash that all trees share."""
    return np.mod(ids, PRIME) * 48271 + seed * 7919


def _drawn(base: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is in the tree's bootstrap."""
    h = _mod_prime(base + (tree + 1) * 69621)
    h = _mod_prime((h ^ (h >> 15)) * 16807)
    h = _mod_prime((h ^ (h >> 13)) * 39373).astype(np.int32)
    times = (h >= LIMITS[0]).view(np.uint8)
    for limit in LIMITS[1:]:
        times += h >= limit
    return times


def bootstrap_counts(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the tree's bootstrap."""
    return _drawn(_hash_base(ids, seed), tree).astype(np.int64)


def bootstrap_hash_sql(row_id: str, tree: str, seed: int) -> str:
    """The hash of a row (ids from 0) as SQL over whole numbers."""
    h = f"(({row_id} % {PRIME}) * 48271 + ({tree} + 1) * 69621 + {seed * 7919}) % {PRIME}"
    for shift, factor in ((15, 16807), (13, 39373)):
        h = f"(xor({h}, ({h}) >> {shift}) * {factor}) % {PRIME}"
    return h


@dataclass
class Forest:
    """``weights``: (trees, 2) class weights; ``trees`` as in the boosting;
    their values are probabilities of class 1, ``hess`` counts rows."""

    cuts: list
    weights: np.ndarray
    trees: list = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), 0.5)
        b = BoostedTrees(self.cuts).bins(x)
        return sum((t.score(b) for t in self.trees), np.zeros(len(x))) / len(self.trees)


def bootstrap_classes(rows: DataFrame, n_trees: int, seed: int) -> DataFrame:
    """(tree, label, n) of ``rows`` (id long, label double 0 or 1): one row per
    tree and class that its bootstrap holds."""
    def run(batches):
        n = np.zeros((n_trees, 2), np.int64)
        for b in batches:
            base, y = _hash_base(b.column("id").to_numpy(), seed), b.column("label").to_numpy().astype(np.int64)
            for t in range(n_trees):
                n[t] += np.bincount(y, _drawn(base, t), 2).astype(np.int64)
        tree, label = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tree.astype(np.int32)), pa.array(label.astype(np.int32)), pa.array(n[tree, label])],
            ["tree", "label", "n"])
    return rows.select("id", "label").mapInArrow(run, "tree int, label int, n long").groupBy("tree", "label").agg(
        F.sum("n").alias("n"))


def class_weights(data: DataFrame, id_col: str, label_col: str = "label", n_trees: int = 300, seed: int = 42) -> DataFrame:
    """(tree, label, n, weight): the classes of every bootstrap and their
    balanced weights."""
    counts = bootstrap_classes(_plain(data, id_col, label_col), n_trees, seed)
    # n_trees rows of two classes at most
    total = counts.groupBy("tree").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes"))
    return counts.join(total, "tree").select("tree", "label", "n", (
        F.col("total").cast("double") / (F.col("classes") * F.col("n")).cast("double")).alias("weight"))


def _plain(data: DataFrame, id_col: str, label_col: str, *more) -> DataFrame:
    return data.filter(F.col(label_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"), F.col(label_col).cast("double").alias("label"), *more)


def _widths(columns: np.ndarray, width) -> np.ndarray:
    """Bins of each (slot, feature) of ``columns``; ``width`` is the number of
    bins of every feature, or has one number per feature."""
    return np.full(columns.shape, width) if np.ndim(width) == 0 else np.asarray(width)[columns]


def _add_cells(total: np.ndarray, work: list, bins: np.ndarray, ids: np.ndarray, y: np.ndarray, k: int, width,
               seed: int, level: int) -> None:
    """Adds a block of at most ``PACK_ROWS`` rows to the three sums of each
    cell; the cells of a tree lie by slot, feature and bin.  The three are added
    up in one number (below 2^53, so exact)."""
    n_features, plans, before = bins.shape[1], [], 0
    for number, tree, slots, columns in work:
        widths = _widths(columns, width)
        size = int(widths.sum())
        first = (np.cumsum(widths) - widths.ravel()).reshape(columns.shape)
        # at a leaf a row goes to the leaf again
        inner = tree.feature >= 0
        walk = (np.maximum(tree.feature, 0), np.where(inner, tree.cut, 255).astype(np.uint8),
                np.where(inner, 2, 1) * np.arange(len(inner)))
        plans.append((number, walk, slots, [*columns.T.copy()], [*first.T.copy()], slice(before, before + size), size))
        before += size
    packed = np.zeros(before)
    for a in range(0, len(ids), CACHE_ROWS):
        flat = bins[a:a + CACHE_ROWS].ravel()
        base, row_start = _hash_base(ids[a:a + CACHE_ROWS], seed), np.arange(len(ids[a:a + CACHE_ROWS])) * n_features
        unit = np.where(y[a:a + CACHE_ROWS] == 1, float(1 << PACK_BITS), 1.0)
        for number, (feature, cut, below), slots, columns, first, cells, size in plans:
            times = _drawn(base, number)
            at = np.flatnonzero(times != 0)
            start, node = row_start.take(at), np.ones(len(at), np.intp)
            # no node lies below the level that is being split
            for _ in range(level):
                right = flat.take(feature.take(node) + start) > cut.take(node)
                node = below.take(node) + right
            slot = slots.take(node)
            open_ = np.flatnonzero(slot >= 0)
            if len(open_) < len(at):
                at, slot, start = at.take(open_), slot.take(open_), start.take(open_)
            cell = np.empty((k, len(at)), np.intp)
            for j in range(k):
                np.add(first[j].take(slot), flat.take(columns[j].take(slot) + start), out=cell[j])
            weight = times.take(at) * unit.take(at) + float(1 << 2 * PACK_BITS)
            packed[cells] += np.bincount(cell.ravel(), np.tile(weight, k), size)
    mask = (1 << PACK_BITS) - 1
    for *_, cells, _ in plans:
        got = packed[cells].astype(np.int64)
        for j, v in enumerate((got & mask, (got >> PACK_BITS) & mask, got >> 2 * PACK_BITS)):
            total[j, cells] += v


def _job_cells(rows: DataFrame, work: list, n_features: int, width: np.ndarray, k: int, seed: int, level: int) -> pa.Table:
    """Bootstrap rows of class 0 and of class 1, and different rows, of each
    cell.  ``work`` lists (tree number, Tree, slot of each node or -1, features
    of each slot); slots are numbered through."""
    shared = rows.sparkSession.sparkContext.broadcast(work)

    def run(batches):
        work = shared.value
        total = np.zeros((3, sum(int(_widths(cols, width).sum()) for *_, cols in work)), np.int64)

        def add(block):
            table = pa.Table.from_batches(block)
            whole = table.combine_chunks().to_batches()[0]
            _add_cells(total, work, matrix(whole, n_features), whole.column("id").to_numpy(), whole.column("label").to_numpy(),
                       k, width, seed, level)
        block, n = [], 0
        for b in (b.slice(a, PACK_ROWS) for b in batches for a in range(0, b.num_rows, PACK_ROWS)):
            if block and n + b.num_rows > PACK_ROWS:
                add(block)
                block, n = [], 0
            block.append(b)
            n += b.num_rows
        if block:
            add(block)
        at = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(at)] + [pa.array(t[at]) for t in total], ["cell", "n0", "n1", "r"])
    out = (rows.mapInArrow(run, "cell long, n0 long, n1 long, r long").groupBy("cell")
           .agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "r")]).toArrow())
    shared.unpersist()
    return out


def impurity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Gini impurity times the weight of a node with class weights a and b."""
    w = a + b
    return 2.0 * a * b / np.where(w > 0, w, 1.0)


def _split(tree: Tree, weight: np.ndarray, nodes: list, columns: np.ndarray, sums: np.ndarray, cuts: list, min_leaf: int,
           splits_below: bool) -> list:
    """Splits the open ``nodes`` by ``sums`` (3, nodes, features, bins); returns
    the children to be looked at in the next level.  Ties go to the feature
    drawn first, then to the smaller bin."""
    width = sums.shape[3]
    left = sums.cumsum(3)
    a, b = left[0] * weight[0], left[1] * weight[1]
    # every feature of a node adds up to the same rows
    at, bt, rt = a[:, :1, -1:], b[:, :1, -1:], left[2][:, :1, -1:]
    bounded = np.arange(width) < np.array([len(c) for c in cuts])[columns][..., None]
    gain = impurity(at, bt) - impurity(a, b) - impurity(at - a, bt - b)
    gain = np.where(bounded & (left[2] >= min_leaf) & (rt - left[2] >= min_leaf), gain, -np.inf)
    best = gain.reshape(len(nodes), -1).argmax(1)
    out = []
    for i, number in enumerate(nodes):
        f, cut = divmod(int(best[i]), width)
        if number == 1:
            tree.value[1] = bt[i, 0, 0] / max(at[i, 0, 0] + bt[i, 0, 0], 1e-300)
        # below this a gain is rounding error
        if not gain[i, f, cut] > 1e-9 * (at[i, 0, 0] + bt[i, 0, 0]):
            continue
        tree.feature[number], tree.cut[number], tree.gain[number] = columns[i, f], cut, gain[i, f, cut]
        la, lb, lr = a[i, f, cut], b[i, f, cut], left[2][i, f, cut]
        tree.hess[2 * number], tree.hess[2 * number + 1] = lr, rt[i, 0, 0] - lr
        for child, ca, cb, cr in ((2 * number, la, lb, lr), (2 * number + 1, at[i, 0, 0] - la, bt[i, 0, 0] - lb, rt[i, 0, 0] - lr)):
            tree.value[child] = cb / (ca + cb)
            if splits_below and cr >= 2 * min_leaf and min(ca, cb) > 1e-9 * (ca + cb):
                out.append(child)
    return out


def fit_forest(data: DataFrame, id_col: str, features_col: str = "features", label_col: str = "label", n_trees: int = 300,
               depth: int = 10, min_leaf: int = 20, bins: int = 64, seed: int = 42, cuts: list | None = None,
               columns_per_node: int | None = None) -> Forest:
    """``cuts`` sets the limits of each feature (at most 255), else they are
    quantiles; ``columns_per_node`` is the whole root of the features' number
    unless given."""
    kind = dict(data.dtypes)[features_col]
    x = F.col(features_col) if kind.startswith("array") else vector_to_array(features_col)
    plain = _plain(data, id_col, label_col, x.alias("x"))
    head = plain.first()
    if head is None:
        return Forest([], np.zeros((0, 2)))
    n_features = len(head["x"])
    cuts = [np.asarray(c, float) for c in cuts] if cuts else quantile_cuts(plain, n_features, min(bins, 256))
    # a feature has as many cells as bins: the two of a flag, not the most of any
    width, k = np.array([len(c) + 1 for c in cuts]), columns_per_node or max(1, math.isqrt(n_features))
    # each level waits for its longest task
    cores = data.sparkSession.sparkContext.defaultParallelism
    rows = binned_rows(plain, cuts, n_features, cores * math.ceil(plain.count() / (cores * PART_ROWS)))
    weights = np.zeros((n_trees, 2))
    for r in class_weights(rows, "id", n_trees=n_trees, seed=seed).collect():
        weights[r.tree, r.label] = r.weight
    forest = Forest(cuts, weights, [Tree.empty(depth) for _ in range(n_trees)])
    # a bootstrap of few rows may hold none: no tree
    nodes = {t: [1] for t in range(n_trees) if weights[t].any()}
    most = int(np.sort(width)[-k:].sum())  # cells of a node at most
    for level in range(depth):
        todo = [t for t in nodes if nodes[t]]
        while todo:
            work, cells = [], 0
            while todo and (not work or cells + most * len(nodes[todo[0]]) <= CELLS):
                t = todo.pop(0)
                slots = np.full(2 << depth, -1)
                slots[nodes[t]] = np.arange(len(nodes[t]))
                columns = np.stack([np.random.default_rng([seed, t, n]).choice(n_features, k, replace=False) for n in nodes[t]])
                work.append((t, forest.trees[t], slots, columns))
                cells += int(width[columns].sum())
            got = _job_cells(rows, work, n_features, width, k, seed, level)
            sums = np.zeros((3, cells), np.int64)
            sums[:, got.column("cell").to_numpy()] = [got.column(c).to_numpy() for c in ("n0", "n1", "r")]
            before = 0
            for t, tree, _, columns in work:
                of_bin = np.arange(width.max()) < width[columns][..., None]
                part = np.zeros((3, *of_bin.shape), np.int64)
                part[:, of_bin] = sums[:, before:(before := before + int(width[columns].sum()))]
                nodes[t] = _split(tree, weights[t], nodes[t], columns, part, cuts, min_leaf, level + 1 < depth)
    release(rows)
    forest.trees = [forest.trees[t] for t in nodes]
    return forest


def score_forest(model: Forest, df: DataFrame, features_col: str = "features", out: str = "churn_probability") -> DataFrame:
    """``df`` with the probability of class 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def p(x: pd.Series) -> pd.Series:
        return pd.Series(shared.value.probability(np.stack(x.to_numpy())) if len(x) else np.zeros(0))
    kind = dict(df.dtypes)[features_col]
    return df.withColumn(out, p(F.col(features_col) if kind.startswith("array") else vector_to_array(features_col)))


def split_table(model: Forest, spark: SparkSession) -> DataFrame:
    """(tree, node, feature, bin, gain, rows_left) of every split; at most
    trees x 2^depth rows."""
    rows = [(i, int(n), int(t.feature[n]), int(t.cut[n]), float(t.gain[n]), int(t.hess[2 * n]))
            for i, t in enumerate(model.trees) for n in np.flatnonzero(t.feature >= 0)]
    return spark.createDataFrame(rows, "tree int, node int, feature int, bin int, gain double, rows_left long")


def importances(model: Forest, names: list, spark: SparkSession) -> DataFrame:
    """Mean decrease of the impurity per feature, each tree's shares adding up
    to 1 (trees without a split left out), then over all features."""
    total = np.zeros(len(names))
    for t in model.trees:
        own = np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], len(names))
        if own.sum() > 0:
            total += own / own.sum()
    total /= max(total.sum(), 1e-300)
    return spark.createDataFrame([(i, n, float(v)) for i, (n, v) in enumerate(zip(names, total))],
                                 "feature_index int, feature string, importance double")
