"""Preprocessing pipeline, classifiers, scoring and comparison.

Layout of the feature vector: the six numeric features (median-imputed),
then one one-hot block per categorical column.  One-hot keeps every
category (alphabetical order); unknown or missing categories encode to all
zeros (StringIndexer ``keep`` puts them in an extra slot that ``dropLast``
removes).
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnframe.functions.policy import churn_flag, threshold_for_mode
from churnframe.ml.transformers import FeatureEngineer, MedianImputer, ModeImputer
from churnframe.schema import CATEGORICAL_SETS, NUMERIC_FEATURES

FEATURES = "features"

#: training rows that stay as they lie (bootstraps are drawn by partition), and
#: rows of a task beyond that
SPREAD_ROWS, PART_ROWS = 200_000, 1_000_000


def categorical_columns(feature_set: str = "with_senior") -> list[str]:
    """Named categorical sets plus the engineered ``tenure_band``."""
    base = [c for c in CATEGORICAL_SETS[feature_set] if c not in NUMERIC_FEATURES]
    return list(base) + ["tenure_band"]


def build_preprocessor(feature_set: str = "with_senior") -> Pipeline:
    cats = categorical_columns(feature_set)
    idx = [f"{c}__idx" for c in cats]
    ohe = [f"cat__{c}" for c in cats]
    num = [f"num__{c}" for c in NUMERIC_FEATURES]
    return Pipeline(stages=[
        FeatureEngineer(),
        MedianImputer(inputCols=NUMERIC_FEATURES),
        ModeImputer(inputCols=cats),
        StringIndexer(inputCols=cats, outputCols=idx, stringOrderType="alphabetAsc",
                      handleInvalid="keep"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        _NumericAliases(NUMERIC_FEATURES),
        VectorAssembler(inputCols=num + ohe, outputCol=FEATURES, handleInvalid="keep"),
    ])


def _NumericAliases(cols):
    # copy imputed numerics to ``num__<name>`` so vector slot names follow the
    # ``num__x`` / ``cat__x_value`` convention
    from pyspark.ml.feature import SQLTransformer
    sel = ", ".join(["*"] + [f"CAST({c} AS DOUBLE) AS num__{c}" for c in cols])
    return SQLTransformer(statement=f"SELECT {sel} FROM __THIS__")


def feature_names(transformed: DataFrame, col: str = FEATURES) -> list[str]:
    """Slot names of the assembled vector from its ML attribute metadata."""
    meta = transformed.schema[col].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    attrs.sort(key=lambda a: a["idx"])
    return [a["name"] for a in attrs]


def logistic_regression(n_train: int, weight_col: str | None = "weight") -> LogisticRegression:
    """L2 (C = 1) on unscaled inputs; with balanced weights the weights sum to
    n, so Spark's weight-normalised loss matches at regParam = 1 / n."""
    lr = LogisticRegression(featuresCol=FEATURES, labelCol="label", maxIter=1000,
                            regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
                            standardization=False)
    return lr.setWeightCol(weight_col) if weight_col else lr


def random_forest(num_trees: int = 300, weight_col: str | None = "weight",
                  seed: int = 42) -> RandomForestClassifier:
    # a larger node-statistics budget lets each pass over the data grow more
    # nodes (fewer passes); node ids are cached between levels
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol="label", numTrees=num_trees,
                                maxDepth=10, minInstancesPerNode=20,
                                featureSubsetStrategy="sqrt", subsamplingRate=1.0, seed=seed,
                                maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)
    return rf.setWeightCol(weight_col) if weight_col else rf


def gradient_boosting(max_iter: int = 300, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(featuresCol=FEATURES, labelCol="label", maxIter=max_iter, maxDepth=4,
                         stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                         seed=seed)


def positive_probability(df: DataFrame, col: str = "probability") -> DataFrame:
    return df.withColumn("churn_probability", vector_to_array(F.col(col))[1])


def score(model: PipelineModel, requests: DataFrame, mode_col: str = "mode") -> DataFrame:
    """Features -> probability -> mode threshold -> inclusive flag."""
    scored = positive_probability(model.transform(requests))
    return (scored.withColumn("threshold", threshold_for_mode(mode_col))
            .withColumn("churn_flag", churn_flag("churn_probability", "threshold")))


def score_requests(model: PipelineModel, requests: DataFrame):
    """The scoring path of batch and stream: fill in the default mode,
    validate, score the valid requests.  Returns (scored, rejected); rejected
    rows carry the names of the rules they broke."""
    from churnframe.operators.validate import split_valid
    valid, rejected = split_valid(requests)
    return score(model, valid.drop("violations", "is_valid")), rejected


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def labelled(view: DataFrame, target: str = "churn_target") -> DataFrame:
    return view.withColumn("label", F.col(target).cast("double"))


def train_test(view: DataFrame, row_id: str = "snapshot_id", test_size: float = 0.2,
               seed: int = 42):
    """Stratified split written once to the shared folder (it feeds several
    fits and evaluations), returned as (train, test)."""
    from churnframe.operators.split import stratified_split
    from churnframe.session import materialize
    s = materialize(stratified_split(labelled(view), "label", row_id, test_size, seed), "split")
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def fit_preprocessor(train: DataFrame, feature_set: str = "with_senior") -> PipelineModel:
    return build_preprocessor(feature_set).fit(train)


def prepared(prep: PipelineModel, train: DataFrame, weighted: bool = True) -> DataFrame:
    """Training features written once to the shared folder: every classifier
    (and each of its iterations) then reads the assembled vectors instead of
    recomputing joins, imputation and encoding.  More than ``SPREAD_ROWS`` rows
    are dealt out evenly: each level of a tree waits for its longest task."""
    from churnframe.operators.split import with_class_weights
    from churnframe.session import materialize
    data = with_class_weights(train, "label") if weighted else train
    cols = ["label", FEATURES] + (["weight"] if weighted else [])
    out, rows, cores = prep.transform(data).select(*cols), train.count(), train.sparkSession.sparkContext.defaultParallelism
    if rows > SPREAD_ROWS:
        out = out.repartition(cores * math.ceil(rows / (cores * PART_ROWS)))
    return materialize(out, "train_features")


def fit_classifier(prep: PipelineModel, features: DataFrame, classifier) -> PipelineModel:
    """Fit on prepared features; the result scores raw requests end to end."""
    return PipelineModel(stages=list(prep.stages) + [classifier.fit(features)])


def fit(train: DataFrame, classifier, feature_set: str = "with_senior",
        weighted: bool = True) -> PipelineModel:
    prep = fit_preprocessor(train, feature_set)
    return fit_classifier(prep, prepared(prep, train, weighted), classifier)
