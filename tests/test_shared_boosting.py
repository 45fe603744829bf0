"""A shared grid of boosted trees against Spark's own fits of every point."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewscope.models import frames, shared_boosting, trees, tuning

GRID = {"maxDepth": [1, 3], "maxBins": [7, 20], "minInfoGain": [0.0, 0.02], "stepSize": [0.1, 0.4]}


@pytest.fixture(scope="module")
def rows(spark):
    pick = random.Random(5)
    data = []
    for i in range(900):
        a, b, c = pick.random(), float(pick.randrange(5)), pick.random()
        data.append((i, a, b, c, float((a > 0.4) ^ (b > 2) ^ (pick.random() < 0.15))))
    df = spark.createDataFrame(data, "row_id int, user_id double, review_id double, business_id double, label double")
    return frames.assemble().transform(df).cache()


def _boosted(**settings):
    return trees.boosted_pipeline(**{"maxIter": 4, **settings}).getStages()[-1]


def test_every_point_equals_its_own_fit(rows, monkeypatch):
    model = tuning.tune_on_split(_boosted(), GRID, tuning.weighted_f1(), rows, "row_id")
    monkeypatch.setattr(shared_boosting, "confusions", lambda *_: None)
    single = tuning.tune_on_split(_boosted(), GRID, tuning.weighted_f1(), rows, "row_id", parallelism=8)
    assert model.validationMetrics == pytest.approx(single.validationMetrics, abs=1e-12)
    assert len(set(model.validationMetrics)) > 4
    best = [max(m.validationMetrics) for m in (model, single)]
    assert best[0] == pytest.approx(best[1]) and model.bestModel.totalNumNodes > 4


def test_only_the_best_point_is_fitted_by_itself(rows, monkeypatch):
    fits = []
    fit = type(_boosted()).fit
    monkeypatch.setattr(type(_boosted()), "fit", lambda self, *a: (fits.append(a), fit(self, *a))[1])
    tuning.tune_on_split(_boosted(), GRID, tuning.weighted_f1(), rows, "row_id")
    assert len(fits) == 1


def test_what_can_not_be_shared_is_fitted_point_by_point(rows, monkeypatch):
    validating = tuning.in_validation_part("row_id")
    points = tuning.build_grid(_boosted(), {"maxDepth": [1]})
    assert shared_boosting.confusions(_boosted(subsamplingRate=0.5), points, rows, validating, "row_id") is None
    assert shared_boosting.confusions(_boosted(), tuning.build_grid(_boosted(), {"minInstancesPerNode": [9]}), rows, validating, "row_id") is None
    assert shared_boosting.confusions(_boosted(), points, rows.limit(0), validating, "row_id") is None
    monkeypatch.setattr(shared_boosting, "CELLS_AT_MOST", 10)
    assert shared_boosting.confusions(_boosted(), points, rows, validating, "row_id") is None


def test_all_rows_are_judged_and_keys_may_repeat(rows):
    odd = rows.withColumn("row_id", F.when(F.col("row_id") % 7 > 0, F.col("row_id") % 100))
    points = tuning.build_grid(_boosted(), {"maxDepth": [2]})
    counts = shared_boosting.confusions(_boosted(), points, odd, F.col("label") >= 0.5, "row_id")
    assert [c[0] + c[3] for c in counts] == [odd.where("label = 1").count()] and counts[0][1] == counts[0][2] == 0


def test_cuts_share_the_values():
    assert shared_boosting.cuts_of(np.array([3.0, 1.0, 2.0, 2.0]), 5).tolist() == [1.5, 2.5]
    assert shared_boosting.cuts_of(np.arange(100.0), 3).tolist() == [24.5, 49.5, 74.5]
