"""Properties from the test strategy: shares sum to one, AUC by ranks equals
Spark's evaluator, model factories carry the reference hyper-parameters."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from churnframe.ml import pipeline as MP
from churnframe.plans.catalog import QUERIES, _scored


def test_shares_sum_to_one(spark, sf):
    per = QUERIES["label_share_by_contract"](spark, sf).groupBy("contract_type") \
        .agg(F.sum("rate").alias("s")).collect()
    assert per and all(abs(r.s - 1.0) < 1e-12 for r in per)
    tot = QUERIES["target_share"](spark, sf).agg(F.sum("share")).first()[0]
    assert abs(tot - 1.0) < 1e-12


def test_auc_equals_spark_evaluator(spark, sf):
    ours = QUERIES["roc_auc"](spark, sf).first().auc
    scored = _scored(spark, sf).select(F.col("score").alias("rawPrediction"),
                                       F.col("label").cast("double").alias("label"))
    spark_auc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0) \
        .evaluate(scored)
    assert abs(ours - spark_auc) < 1e-12


def test_model_factories_defaults():
    rf = MP.random_forest()
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getMinInstancesPerNode(), rf.getSeed()) \
        == (300, 10, 20, 42)
    gbt = MP.gradient_boosting()
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSubsamplingRate()) \
        == (300, 4, 0.05, 0.8)
    lr = MP.logistic_regression(1000)
    assert lr.getMaxIter() == 1000 and lr.getRegParam() == 1 / 1000 \
        and not lr.getStandardization()
