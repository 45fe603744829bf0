"""Gradient steps against numpy; the gradient at Spark ML's own optimum."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewscope.models import sentiment
from reviewscope.models import sparse_logistic as sl

WIDTH = 12


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (300, WIDTH)) * (rng.random((300, WIDTH)) < 0.4)
    x[7] = 0
    x[:, 3] = 2  # no variance
    y = (x[:, 0] - x[:, 1] + rng.normal(0, 1, 300) > 0).astype(float)
    return x.astype(float), y


@pytest.fixture(scope="module")
def rows(spark, matrix):
    x, y = matrix
    listed = [([int(j) for j in np.flatnonzero(r)], [float(r[j]) for j in np.flatnonzero(r)], float(v)) for r, v in zip(x, y)]
    df = spark.createDataFrame([*listed, ([1], [1.0], None)], "buckets array<int>, weights array<double>, label double")
    return df.repartition(5)


def test_steps_equal_numpy(spark, rows, matrix):
    x, y = matrix
    n, variance = sl.variances(rows.where("label is not null"))
    assert n == 300 and np.allclose(variance[:WIDTH], x.var(0, ddof=1)) and not variance[WIDTH:].any()
    b, w, v = 0.0, np.zeros(WIDTH), x.var(0, ddof=1)
    for _ in range(4):
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        g = x.T @ error / 300 + 0.05 * v * w
        b, w = b - 0.1 * error.mean(), w - 0.1 * np.divide(g, v, out=np.zeros(WIDTH), where=v > 0)
    fit = sl.fit_steps(rows, 4, 0.1, 0.05)
    assert abs(fit.intercept - b) < 1e-12 and np.abs(fit.coefficients[:WIDTH] - w).max() < 1e-12
    assert fit.coefficients[3] == 0
    judge = sl.probability(spark, fit)
    one = spark.createDataFrame([([0, 1], [2.0, 1.0]), ([], [])], "buckets array<int>, weights array<double>")
    got = [r[0] for r in one.select(judge("buckets", "weights")).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-np.array([2 * w[0] + w[1] + b, b]))))


def test_spark_optimum_has_no_gradient(spark, rows, matrix):
    x, y = matrix
    vectors = spark.createDataFrame([(Vectors.dense(r), float(v)) for r, v in zip(x, y)], ["features", "label"])
    model = LogisticRegression(regParam=0.01, maxIter=500, tol=1e-12).fit(vectors)
    coefficients = np.zeros(sl.BUCKETS)
    coefficients[:WIDTH] = model.coefficients.toArray()
    labelled = rows.where("label is not null")
    n, variance = sl.variances(labelled)
    by_intercept, by_coefficient = sl.gradient(labelled, sl.SparseFit(model.intercept, coefficients), n, 0.01 * variance)
    far = sl.gradient(labelled, sl.SparseFit(), n, 0.01 * variance)[1]
    # In units of standardised features; a bucket without variance is none of them.
    size = np.sqrt(np.divide(by_coefficient**2, variance, out=np.zeros(sl.BUCKETS), where=variance > 0).sum() + by_intercept**2)
    assert size < 1e-6 < np.abs(far).max()


def test_text_fit_is_close_to_its_optimum(spark):
    from reviewscope.plans import standin

    texts = standin.labelled_texts(spark, "/root/testdata/sf0.01")
    model = sentiment.fit_sentiment(texts, "doc_id", max_iter=100)
    hashed = model.transform(texts)
    rows = hashed.select(*sl.entry_rows(sentiment.sparse_entries(F.col("features")), "label")).cache()
    n, variance = sl.variances(rows)
    fit = sl.SparseFit(model.stages[-1].intercept, model.stages[-1].coefficients.toArray())
    by_intercept, by_coefficient = sl.gradient(rows, fit, n, 0.01 * variance)
    size = np.sqrt(np.divide(by_coefficient**2, variance, out=np.zeros(sl.BUCKETS), where=variance > 0).sum() + by_intercept**2)
    assert size < 1e-3


def test_no_rows(spark):
    empty = spark.createDataFrame([], "buckets array<int>, weights array<double>, label double")
    fit = sl.fit_steps(empty, 2, 0.1, 0.1)
    assert fit.intercept == 0 and not fit.coefficients.any()
