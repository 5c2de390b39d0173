"""The forest's cells follow the bins of each feature, and a level's rows lie in
parts of equal size."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from churnframe.ml import forest as RF
from churnframe.ml.boosting import matrix


def test_flags_take_two_cells_each(spark, monkeypatch):
    # one feature of 64 bins among eight flags
    x = F.array((F.col("id") % 64).cast("double"), *[((F.col("id") * (k + 3)) % (k + 5) == 0).cast("double") for k in range(8)])
    made = spark.range(4000).select("id", ((F.col("id") * 7919) % 13 < 5).cast("double").alias("label"), x.alias("features"))
    cuts = [list(range(63))] + [[0]] * 8
    want = RF.fit_forest(made, "id", n_trees=12, depth=3, cuts=cuts)
    jobs, plain = [], RF._job_cells
    monkeypatch.setattr(RF, "CELLS", 1500)
    monkeypatch.setattr(RF, "_job_cells", lambda rows, work, *a: jobs.append((len(work), rows.rdd.getNumPartitions())) or plain(rows, work, *a))
    got = RF.fit_forest(made.coalesce(1), "id", n_trees=12, depth=3, cuts=cuts)
    for t, u in zip(want.trees, got.trees):
        assert (t.feature == u.feature).all() and (t.cut == u.cut).all() and (t.value == u.value).all()
    # 192 cells a node (64 for each feature) would take 2 + 3 + 6 jobs
    assert sum(n for n, _ in jobs) == 36 and len(jobs) <= 7, jobs
    assert min(p for _, p in jobs) > 1, jobs


def test_bins_of_a_sliced_batch():
    rows = [bytes([i, i + 1, i + 2]) for i in range(10)]
    b = pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["bins"])
    assert (matrix(b.slice(4, 3), 3) == np.frombuffer(b"".join(rows[4:7]), np.uint8).reshape(3, 3)).all()
    assert matrix(b.slice(0, 0), 3).shape == (0, 3)
