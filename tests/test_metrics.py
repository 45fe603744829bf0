import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)

from reviewscope.operators import evaluate

SCHEMA = "prediction double, trueLabel double"


def scored(spark, seed, share, skill):
    pick = random.Random(seed)
    rows = []
    for _ in range(500):
        y = float(pick.random() < share)
        rows.append((y if pick.random() < skill else float(pick.random() < 0.5), y))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed, share, skill", [(1, 0.5, 0.8), (2, 0.9, 0.1), (3, 0.2, 0.0), (4, 0.7, 1.0)])
def test_one_pass_metrics_equal_the_evaluators(spark, seed, share, skill):
    df = scored(spark, seed, share, skill)
    f1 = MulticlassClassificationEvaluator(labelCol="trueLabel").evaluate(df)
    auc = BinaryClassificationEvaluator(labelCol="trueLabel", rawPredictionCol="prediction").evaluate(df)
    rmse = RegressionEvaluator(labelCol="trueLabel").evaluate(df)
    assert evaluate.f1_weighted(df).first()[0] == pytest.approx(f1, abs=1e-9)
    assert evaluate.auc_hard(df).first()[0] == pytest.approx(auc, abs=1e-9)
    assert evaluate.rmse(df).first()[0] == pytest.approx(rmse, abs=1e-9)
    counts = evaluate.confusion_counts(df).first()
    assert sum(counts) == df.count()


def test_always_positive_scores_the_majority_baseline(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 78 + [(1.0, 0.0)] * 22, SCHEMA)
    report = {r["metric"]: r["value"] for r in evaluate.classifier_report(df).collect()}
    assert report["F1 weighted"] == pytest.approx(report["F1 weighted, majority class"]) == pytest.approx(0.68360, abs=1e-5)
    assert report["AUC hard"] == 0.5


def test_empty_classes_give_null(spark):
    none_positive = spark.createDataFrame([(0.0, 0.0)], SCHEMA)
    assert tuple(evaluate.precision_recall(none_positive).first()) == (None, None)
    assert evaluate.auc_hard(none_positive).first()[0] is None
    empty = spark.createDataFrame([], SCHEMA)
    table = {r["metric"]: r["value"] for r in evaluate.metrics_table(empty).collect()}
    assert table == {"TP": 0, "FP": 0, "TN": 0, "FN": 0, "Precision": None, "Recall": None}
    assert evaluate.f1_weighted(empty).first()[0] is None and evaluate.rmse(empty).first()[0] is None


def test_rating_report_counts_rows_without_score(spark):
    df = spark.createDataFrame([(0.4, 1.0), (-0.6, 1.0), (float("nan"), 0.0), (None, 1.0)], SCHEMA)
    row = evaluate.rating_report(df).first()
    assert (row["n_rows"], row["n_scored"]) == (4, 2) and row["rmse"] == pytest.approx(0.5 ** 0.5)
