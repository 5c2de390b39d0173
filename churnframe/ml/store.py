"""Versioned store of fitted models.

A model is kept under a key made of its kind, its parameters and a fingerprint
of the rows it was trained on.  ``load_or_fit`` loads it if it is there, else
fits it, writes it beside its place and moves it there in one rename: readers
see a whole model or none, and of two sessions that fit the same model at once
one keeps its copy and the other uses that.

The fingerprint adds up a hash of each row (and of the schema), so it does not
depend on order or partitioning; one aggregation over the training rows, no
sort.  Equal rows are told apart by their number.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnframe.session import ensure_checkpoint_dir


def fingerprint(df: DataFrame) -> str:
    """Hex digest of the rows of ``df`` as a bag."""
    row = F.struct(*[F.col(c) for c in sorted(df.columns)])
    total = df.select(F.xxhash64(row).cast("decimal(38,0)").alias("a"),
                      F.xxhash64(F.lit(7), row).cast("decimal(38,0)").alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    return hashlib.sha256(repr((sorted(df.dtypes), total.n, str(total.a), str(total.b))).encode()).hexdigest()


def parameters(estimator) -> dict:
    """All parameters of an estimator, set or default, by name."""
    return {p.name: str(v) for p, v in estimator.extractParamMap().items()}


class ModelStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or ensure_checkpoint_dir(spark).rstrip("/") + "/churnframe/models").rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self, kind: str, params: dict, trained_on: str) -> str:
        text = json.dumps([kind, params, trained_on], sort_keys=True)
        return f"{self.root}/{kind}-{hashlib.sha256(text.encode()).hexdigest()[:24]}"

    def has(self, kind: str, params: dict, trained_on: str) -> bool:
        p, fs = self._fs(self.path(kind, params, trained_on))
        return fs.exists(p)

    def load_or_fit(self, kind: str, params: dict, trained_on: str, fit: Callable[[], PipelineModel]) -> PipelineModel:
        path = self.path(kind, params, trained_on)
        place, fs = self._fs(path)
        if fs.exists(place):
            return PipelineModel.load(path)
        model = fit()
        draft = f"{self.root}/_drafts/{uuid.uuid4().hex}"
        model.write().save(draft)
        source, _ = self._fs(draft)
        # a rename onto a folder that is there would move the draft into it
        if fs.exists(place) or not fs.rename(source, place):
            fs.delete(source, True)
            return PipelineModel.load(path)
        return model

    def versions(self) -> list[str]:
        """Names of the models kept."""
        root, fs = self._fs(self.root)
        if not fs.exists(root):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(root) if not s.getPath().getName().startswith("_"))
