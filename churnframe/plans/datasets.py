"""Per-session registry of the derived datasets every query starts from.

The load pipeline (raw extract -> staging -> star schema) runs once per Spark
application and folder; its tables are written to the shared checkpoint
folder and read back, exactly as a warehouse load followed by many analytic
queries.  Everything else stays lazy.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from churnframe.operators.star import Star, load_and_write, stage
from churnframe.operators.view import training_view
from churnframe.session import materialize, scratch_path
from churnframe.sources import fixtures

_REGISTRY: dict = {}


class Datasets:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    @cached_property
    def subscriber(self) -> DataFrame:
        return fixtures.subscriber(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        return fixtures.subscriber_raw(self.spark, self.sf_dir)

    @cached_property
    def staging(self) -> DataFrame:
        """Cleaned rows written once as the staging table: the dimension and
        fact builds read it (column-pruned) instead of re-deriving the raw
        extract three times."""
        return materialize(stage(self.raw), "staging")

    @cached_property
    def star(self) -> Star:
        """The loaded star schema, written once to the shared folder."""
        return load_and_write(self.staging, scratch_path(self.spark, "star"))

    @cached_property
    def view(self) -> DataFrame:
        return training_view(self.star)

    def view_with(self, dims, keep_snapshot_id: bool = False) -> DataFrame:
        return training_view(self.star, dims=dims, keep_snapshot_id=keep_snapshot_id)

    @cached_property
    def split(self):
        """Stratified 80/20 split of the full view (train, test)."""
        from churnframe.ml.pipeline import train_test
        return train_test(self.view_with(("customer", "contract", "services"),
                                         keep_snapshot_id=True))

    @cached_property
    def preprocessor(self):
        from churnframe.ml.pipeline import fit_preprocessor
        return fit_preprocessor(self.split[0])

    @cached_property
    def train_features(self) -> DataFrame:
        from churnframe.ml.pipeline import prepared
        return prepared(self.preprocessor, self.split[0])

    @cached_property
    def store(self):
        from churnframe.ml.store import ModelStore
        return ModelStore(self.spark)

    @cached_property
    def training_fingerprint(self) -> str:
        """Of the labelled accounts that the split and the fits start from."""
        from churnframe.ml.store import fingerprint
        return fingerprint(self.view_with(("customer", "contract", "services"), keep_snapshot_id=True))

    def model(self, kind: str = "rf"):
        """Scoring pipelines at full size, one per kind: from the model store
        if a session has fitted the same model on the same accounts, else
        fitted and stored."""
        cache = self.__dict__.setdefault("_models", {})
        if kind not in cache:
            from churnframe.ml import pipeline as mp
            from churnframe.ml.store import parameters
            make = {"rf": lambda n: mp.random_forest(), "lr": mp.logistic_regression,
                    "gbt": lambda n: mp.gradient_boosting()}[kind]
            # regularisation that follows the number of rows follows the fingerprint
            params = parameters(make(1)) | {"split": "0.2, 42"}
            cache[kind] = self.store.load_or_fit(kind, params, self.training_fingerprint, lambda: mp.fit_classifier(
                self.preprocessor, self.train_features, make(self.train_features.count())))
        return cache[kind]

    @cached_property
    def prediction_log(self) -> DataFrame:
        return fixtures.prediction_log(self.spark, self.sf_dir)


def datasets(spark: SparkSession, sf_dir: str) -> Datasets:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    ds = _REGISTRY.get(key)
    if ds is None:
        ds = Datasets(spark, sf_dir)
        _REGISTRY[key] = ds
    return ds
