"""Logistic regression on hashed terms by gradient passes, and the gradient of any fit.

The objective is Spark ML's: mean logistic loss plus ``reg`` / 2 times the squared coefficients, each
weighed with the variance of its feature (that is what standardised features come to). One pass
over the rows gives the gradient: a task adds up its rows' shares per bucket, so what moves is at
most one number per bucket and task. Coefficients are bounded by the number of buckets and are
what a task needs to know; they travel to the tasks, the rows never do.

``gradient`` at the coefficients of a Spark ML model tells how far that fit is from the optimum.

Edge cases: rows without terms have the intercept as their margin; a bucket that is equal in all rows
has no variance and keeps the coefficient 0; rows with a NULL label are left out of fits; an empty
table gives zero coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 18
PART = "bucket int, share double"


@dataclass
class SparseFit:
    intercept: float = 0.0
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))


def entry_rows(entries: Column, *keep: Column | str) -> list[Column]:
    """Columns ``buckets`` and ``weights`` from an array of (bucket, weight) entries."""
    return [*keep, F.transform(entries, lambda e: e["bucket"]).alias("buckets"), F.transform(entries, lambda e: e["weight"]).alias("weights")]


def _entries(buckets: pa.Array, weights: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = pc.fill_null(pc.list_value_length(buckets), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(buckets)), sizes), buckets.flatten().to_numpy(zero_copy_only=False), weights.flatten().to_numpy(zero_copy_only=False)


def _margins(fit: SparseFit, rows: np.ndarray, buckets: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return fit.intercept + np.bincount(rows, fit.coefficients[buckets] * weights, n)


def _summed(rows: DataFrame, share) -> DataFrame:
    """Sum per bucket of what ``share`` makes of each batch: (buckets, shares); bucket -1 is the intercept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1)
        for batch in batches:
            buckets, shares = share(batch)
            total += np.bincount(buckets + 1, shares, BUCKETS + 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array((at - 1).astype(np.int32)), pa.array(total[at])], ["bucket", "share"])

    return rows.mapInArrow(run, PART).groupBy("bucket").agg(F.sum("share").alias("share"))


def _dense(sums: DataFrame) -> tuple[float, np.ndarray]:
    """At most one row per bucket comes to the driver."""
    table = sums.toArrow()
    out = np.zeros(BUCKETS + 1)
    out[table.column("bucket").to_numpy() + 1] = table.column("share").to_numpy()
    return float(out[0]), out[1:]


def variances(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows, and the sample variance of every bucket's weights over all rows."""
    def moment(power: int):
        def share(batch):
            _, buckets, weights = _entries(batch.column("buckets"), batch.column("weights"))
            return np.append(buckets, -1), np.append(weights ** power, batch.num_rows)

        return _dense(_summed(rows, share))

    (n, first), (_, second) = moment(1), moment(2)
    return int(n), np.maximum(second - first * first / max(n, 1), 0) / max(n - 1, 1)


def gradient(rows: DataFrame, fit: SparseFit, n: int, penalty: np.ndarray) -> tuple[float, np.ndarray]:
    """Derivative of the objective by the intercept and by each coefficient; ``penalty`` is reg times the variances."""
    sent = rows.sparkSession.sparkContext.broadcast(fit)

    def share(batch):
        row, buckets, weights = _entries(batch.column("buckets"), batch.column("weights"))
        margins = _margins(sent.value, row, buckets, weights, batch.num_rows)
        error = 1 / (1 + np.exp(-margins)) - batch.column("label").to_numpy()
        return np.append(buckets, -1), np.append(error[row] * weights, error.sum())

    by_intercept, by_coefficient = _dense(_summed(rows, share))
    sent.unpersist()
    return by_intercept / max(n, 1), by_coefficient / max(n, 1) + penalty * fit.coefficients


def fit_steps(rows: DataFrame, steps: int, rate: float, reg: float) -> SparseFit:
    """``steps`` gradient steps from zero, each coefficient's scaled by its variance. Rows have label, buckets and weights."""
    rows = rows.where("label is not null")
    n, variance = variances(rows)
    fit = SparseFit()
    scale = np.divide(1, variance, out=np.zeros(BUCKETS), where=variance > 0)
    for _ in range(steps):
        by_intercept, by_coefficient = gradient(rows, fit, n, reg * variance)
        fit = SparseFit(fit.intercept - rate * by_intercept, fit.coefficients - rate * scale * by_coefficient)
    return fit


def probability(spark, fit: SparseFit):
    """Column function (buckets, weights) -> probability of label 1."""
    sent = spark.sparkContext.broadcast(fit)

    @F.arrow_udf("double")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for buckets, weights in batches:
            yield pa.array(1 / (1 + np.exp(-_margins(sent.value, *_entries(buckets, weights), len(buckets)))))

    return judge
