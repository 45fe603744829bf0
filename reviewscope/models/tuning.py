"""Parameter grids and tuners."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, Evaluator, MulticlassClassificationEvaluator,
)
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewscope.functions.numbers import is_number
from reviewscope.models import shared_boosting
from reviewscope.models.frames import kept_rows, search_partitions, stable_order
from reviewscope.session import checkpoint_root

# The published parameter grids. alpha is left out of the
# recommender's, it has no effect on explicit ratings.
ALS_GRID = {"rank": [1, 5], "maxIter": [5, 10], "regParam": [0.3, 0.1]}
TREE_GRID = {"maxDepth": [1, 2, 6], "maxBins": [20, 40]}
BOOSTED_GRID = {
    "maxDepth": [2, 3, 4], "maxBins": [49, 52, 55],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3], "stepSize": [0.05, 0.1, 0.2, 0.4],
}


def build_grid(estimator: Estimator, values: dict[str, list]) -> list[dict]:
    """All combinations of ``values`` for ``estimator``, or for the last stage of a pipeline."""
    stage = estimator.getStages()[-1] if isinstance(estimator, Pipeline) else estimator
    grid = ParamGridBuilder()
    for name, options in values.items():
        grid = grid.addGrid(stage.getParam(name), options)
    return grid.build()


def weighted_f1() -> Evaluator:
    return MulticlassClassificationEvaluator(metricName="f1")


def _is_weighted_f1(evaluator: Evaluator) -> bool:
    return (isinstance(evaluator, MulticlassClassificationEvaluator) and evaluator.getMetricName() == "f1"
            and not any(evaluator.isSet(p) for p in evaluator.params if p.name != "metricName"))


def score_auc() -> Evaluator:
    """Area under the ROC of the raw scores."""
    return BinaryClassificationEvaluator(metricName="areaUnderROC")


class ScoredRmse(Evaluator):
    """RMSE over the rows that have a score; infinite where none has.

    A validation part may hold no user and business that were trained on. Such
    a grid point loses against any other instead of ending the search.
    """

    def _evaluate(self, dataset: DataFrame) -> float:
        value, scored = self.rmse_and_count(dataset)
        return value if scored else float("inf")

    def isLargerBetter(self) -> bool:
        return False

    @staticmethod
    def rmse_and_count(dataset: DataFrame) -> tuple[float | None, int]:
        error = F.col("prediction").cast("double") - F.col("label")
        row = dataset.where(is_number(F.col("prediction"))).agg(F.sqrt(F.avg(error * error)), F.count("*")).first()
        return row[0], row[1]


def label_rmse() -> Evaluator:
    return ScoredRmse()


@dataclass
class SplitTuned:
    """Result of a search on one validation part; metrics are in grid order."""

    bestModel: Model
    points: list[dict]
    validationMetrics: list[float]

    def getEstimatorParamMaps(self) -> list[dict]:
        return self.points

    def transform(self, rows: DataFrame) -> DataFrame:
        return self.bestModel.transform(rows)


def in_validation_part(key: str, tenths: int = 2) -> Column:
    """About ``tenths``/10 of the keys, by a hash that is independent of the one that splits off test rows."""
    return F.pmod(F.xxhash64(F.lit("validation"), F.col(key)), F.lit(10)) < tenths


def tune_on_split(
    estimator: Estimator, grid: dict[str, list], evaluator: Evaluator, train: DataFrame, key: str,
    validation_tenths: int = 2, parallelism: int = 4,
) -> SplitTuned:
    """Fit every grid point on the rows outside the validation part, judge on it, refit the best on all.

    Which rows validate depends on ``key`` alone. Boosted trees judged by weighted F1 share their passes over the rows
    (``shared_boosting``); only the best is then fitted by itself.
    """
    checkpoint_root(train.sparkSession)
    points = build_grid(estimator, grid)
    with kept_rows(stable_order(train, key, search_partitions(train))) as rows:
        fitting, judging = rows.where(~in_validation_part(key, validation_tenths)), rows.where(in_validation_part(key, validation_tenths))

        def judge(point: dict) -> float:
            return evaluator.evaluate(estimator.fit(fitting, point).transform(judging))

        counts = shared_boosting.confusions(estimator, points, rows, in_validation_part(key, validation_tenths), key) if _is_weighted_f1(evaluator) else None
        if counts is not None:
            metrics = [shared_boosting.weighted_f1(*c) for c in counts]
        else:
            with ThreadPool(parallelism) as pool:
                metrics = pool.map(inheritable_thread_target(train.sparkSession)(judge), points)
        order = sorted(range(len(points)), key=lambda i: -metrics[i] if evaluator.isLargerBetter() else metrics[i])
        return SplitTuned(estimator.fit(rows, points[order[0]]), points, metrics)


def tune_by_folds(
    estimator: Estimator, grid: dict[str, list], evaluator: Evaluator, train: DataFrame, key: str,
    folds: int = 5, parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validation whose folds depend on ``key`` alone.

    The folds are filters on one kept table, not copies of it; all points of all folds share one pool.
    """
    checkpoint_root(train.sparkSession)
    points = build_grid(estimator, grid)
    fold = F.pmod(F.xxhash64(F.col(key)), F.lit(folds)).cast("int")
    with kept_rows(stable_order(train.withColumn("_fold", fold), key, search_partitions(train))) as rows:

        def judge(task: tuple[int, int]) -> float:
            at, point = task
            fitted = estimator.fit(rows.where(F.col("_fold") != at), points[point])
            return evaluator.evaluate(fitted.transform(rows.where(F.col("_fold") == at)))

        tasks = [(at, point) for at in range(folds) for point in range(len(points))]
        with ThreadPool(parallelism) as pool:
            metrics = np.array(pool.map(inheritable_thread_target(train.sparkSession)(judge), tasks)).reshape(folds, len(points))
        average = metrics.mean(0)
        best = int(average.argmax() if evaluator.isLargerBetter() else average.argmin())
        model = CrossValidatorModel(estimator.fit(rows, points[best]), average.tolist(), stdMetrics=metrics.std(0).tolist())
        model.set(model.estimatorParamMaps, points)
        return model


def grid_table(model: SplitTuned | CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """Every grid point with its validation metric: (point, parameters, metric)."""
    rows = [(i, ", ".join(f"{k}={v}" for k, v in sorted(p.items())), float(m)) for i, (p, m) in enumerate(grid_metrics(model))]
    return spark.createDataFrame(rows, "point int, parameters string, metric double")


def grid_metrics(model: SplitTuned | CrossValidatorModel) -> list[tuple[dict, float]]:
    """Parameters and validation metric of every grid point, in grid order."""
    metrics = model.validationMetrics if isinstance(model, SplitTuned) else model.avgMetrics
    points = [{p.name: v for p, v in m.items()} for m in model.getEstimatorParamMaps()]
    return list(zip(points, metrics))
