"""Decision tree, boosted trees and decision forests on review ids."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, RandomForestClassifier,
)
from pyspark.sql import DataFrame

from reviewscope.models.frames import ID_FEATURES, assemble, kept_rows, stable_order
from reviewscope.session import checkpoint_root

SEED = 42


def tree_pipeline(columns: list[str] = ID_FEATURES, label: str = "label", **settings) -> Pipeline:
    settings = {"maxDepth": 3, "seed": SEED, **settings}
    return Pipeline(stages=[assemble(columns), DecisionTreeClassifier(labelCol=label, **settings)])


def boosted_pipeline(columns: list[str] = ID_FEATURES, label: str = "label", **settings) -> Pipeline:
    settings = {"maxIter": 10, "seed": SEED, **settings}
    return Pipeline(stages=[assemble(columns), GBTClassifier(labelCol=label, **settings)])


def forest_pipeline(columns: list[str] = ID_FEATURES, label: str = "label", **settings) -> Pipeline:
    """Two-class or multi-class, depending on the label column."""
    settings = {"seed": SEED, **settings}
    return Pipeline(stages=[assemble(columns), RandomForestClassifier(labelCol=label, **settings)])


def fit_in_order(pipeline: Pipeline, train: DataFrame, key: str) -> PipelineModel:
    checkpoint_root(train.sparkSession)  # boosting cuts its lineage there
    with kept_rows(stable_order(train, key)) as rows:
        return pipeline.fit(rows)
