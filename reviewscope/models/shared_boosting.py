"""A grid of boosted trees, judged on one validation part from counts that all grid points share.

Trees see a row by its bins and its label alone. So rows are counted once by number of bins and cell (one bin per
feature): a table whose size is bounded by the bins, not by the rows. The points of one number of bins and one step then
boost on those counts side by side in a task of their own, and points whose trees are still equal are grown as one:
smaller depths and larger least gains are prunings of the tree that the deepest point grows.

The steps are those of ``GBTClassifier`` with logistic loss: thresholds between the values of a sample of
max(bins * bins, 10,000) rows, the first tree on labels -1 and 1 with weight 1, the next ones on the pseudo-residuals
with weight ``stepSize``, cuts by the largest gain in variance, the mean as a leaf's value, 1 where the sum is above 0.

Not shared, and None here: settings or grids beyond SETTINGS and GRID, categorical features, more than CELLS_AT_MOST
cells (the counts of one task), no rows to fit on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.session import materialize

GRID = {"maxDepth", "maxBins", "minInfoGain", "stepSize", "maxIter"}
SETTINGS = GRID | {"featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol", "seed", "cacheNodeIds",
                   "checkpointInterval", "maxMemoryInMB"}
CELLS_AT_MOST = 500_000
SAMPLE_ROWS = 10_000
TASKS = 64                # for few groups that should not meet in one task
COUNTS = ["fit_0", "fit_1", "judge_0", "judge_1"]


def can_share(estimator, points: list[dict], rows: DataFrame) -> bool:
    if not isinstance(estimator, GBTClassifier) or not {p.name for p in estimator.extractParamMap() if estimator.isSet(p)} <= SETTINGS:
        return False
    attributes = rows.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return "nominal" not in attributes and all({p.name for p in point} <= GRID for point in points)


def confusions(estimator: GBTClassifier, points: list[dict], rows: DataFrame, judged: Column, key: str) -> list[tuple[int, int, int, int]] | None:
    """(tp, fp, tn, fn) of every point on the ``judged`` rows, fitted on the others."""
    if not can_share(estimator, points, rows):
        return None
    seen = rows.select(
        F.xxhash64(F.lit("bins"), F.col(key)).alias("place"), judged.alias("judged"), vector_to_array(estimator.getFeaturesCol()).alias("features"),
        F.col(estimator.getLabelCol()).cast("double").alias("label"))
    names = ("maxBins", "stepSize", "maxIter", "maxDepth", "minInfoGain")
    own = {n: estimator.getOrDefault(n) for n in names}
    settings = [tuple(({**own, **{p.name: v for p, v in point.items()}})[n] for n in names) for point in points]
    thresholds = sample_thresholds(seen.where(~F.col("judged")), sorted({s[0] for s in settings}))
    if thresholds is None:
        return None
    d = len(next(iter(thresholds.values())))
    cell = ["b", *[f"f{i}" for i in range(d)]]
    counts = ", ".join(["b int", *[f"f{i} int" for i in range(d)], *[f"{c} double" for c in COUNTS]])
    cells = materialize(
        seen.select("judged", "label", *[F.get("features", F.lit(i)).alias(f"f{i}") for i in range(d)]).mapInArrow(_count_cells(thresholds), counts)
        .groupBy(*cell).agg(*[F.sum(c).alias(c) for c in COUNTS]), "cells")
    if (cells.groupBy("b").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > CELLS_AT_MOST:
        return None
    groups = {g: [(i, *s[3:]) for i, s in enumerate(settings) if s[:3] == g] for g in dict.fromkeys(s[:3] for s in settings)}
    tasks = rows.sparkSession.createDataFrame([(g[0], n) for n, g in enumerate(groups)], "b int, task int")
    dealt = cells.join(F.broadcast(tasks), "b").repartition(TASKS, "task")
    found = dealt.groupBy("task").applyInArrow(_boost(list(groups.items()), d), "point int, tp double, fp double, tn double, fn double")
    by_point = {r["point"]: tuple(int(r[c]) for c in ("tp", "fp", "tn", "fn")) for r in found.collect()}
    return [by_point[i] for i in range(len(points))]


def sample_thresholds(rows: DataFrame, max_bins: list[int]) -> dict[int, list[np.ndarray]] | None:
    """Per number of bins and feature the sorted values that end a bin; the rows of the least hash are the sample."""
    total = rows.count()
    if not total:
        return None
    most = max(SAMPLE_ROWS, max(max_bins) ** 2)
    table = (rows if total <= most else rows.orderBy("place", "features").limit(most)).select("features").toArrow()
    sample = np.array(table.column("features").to_pylist(), dtype=np.float64)
    return {b: [cuts_of(sample[:max(SAMPLE_ROWS, b * b), i], min(b, total) - 1) for i in range(sample.shape[1])] for b in max_bins}


def cuts_of(values: np.ndarray, n_cuts: int) -> np.ndarray:
    """At most ``n_cuts`` middles between neighbours, where the counts come closest to equal shares."""
    values, counts = np.unique(values, return_counts=True)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= n_cuts:
        return middles
    stride, upto = counts.sum() / (n_cuts + 1), np.cumsum(counts)
    cuts, target = [], stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            cuts.append(middles[i - 1])
            target += stride
    return np.array(cuts)


def _count_cells(thresholds: dict[int, list[np.ndarray]]):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            if not np.isin(label, (0.0, 1.0)).all():
                raise ValueError("labels other than 0 and 1")
            side = 2 * batch.column("judged").to_numpy(zero_copy_only=False).astype(np.int64) + label.astype(np.int64)
            for b, cuts in thresholds.items():
                bins = np.stack([np.searchsorted(c, batch.column(f"f{i}").to_numpy(zero_copy_only=False), "left") for i, c in enumerate(cuts)], 1)
                cells, at = np.unique(bins, axis=0, return_inverse=True)
                counts = np.zeros((len(cells), 4))
                np.add.at(counts, (at.ravel(), side), 1.0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cells), b, np.int32)), *[pa.array(x.astype(np.int32)) for x in cells.T], *map(pa.array, counts.T.copy())],
                    ["b", *[f"f{i}" for i in range(len(cuts))], *COUNTS])

    return run


def _boost(groups: list[tuple[tuple, list[tuple[int, int, float]]]], d: int):

    def run(table: pa.Table) -> pa.Table:
        (_, step, rounds), points = groups[table.column("task")[0].as_py()]
        table = table.sort_by([(f"f{i}", "ascending") for i in range(d)])  # equal sums for any layout
        bins = [table.column(f"f{i}").to_numpy() for i in range(d)]
        fit_0, fit_1, judge_0, judge_1 = (table.column(c).to_numpy() for c in COUNTS)
        out = []
        for scores, same in boosted(bins, fit_0, fit_1, step, rounds, points):
            hit = scores > 0
            out += [(i, judge_1[hit].sum(), judge_0[hit].sum(), judge_0[~hit].sum(), judge_1[~hit].sum()) for i in same]
        return pa.table([pa.array(x, kind) for x, kind in zip(zip(*out), [pa.int32(), *[pa.float64()] * 4])], ["point", "tp", "fp", "tn", "fn"])

    return run


def boosted(bins, n_0, n_1, step: float, rounds: int, points: list[tuple[int, int, float]]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Scores of all cells after ``rounds`` trees, with the points (number, depth, least gain) that share them."""
    todo = [(0, np.zeros(len(n_0)), points)]
    while todo:
        done, scores, same = todo.pop()
        if done == rounds:
            yield scores, [i for i, _, _ in same]
            continue
        # Pseudo-residuals of the two labels; the first tree is fitted on the labels themselves.
        at_1, at_0 = (4.0 / (1.0 + np.exp(2.0 * scores)), -4.0 / (1.0 + np.exp(-2.0 * scores))) if done else (1.0, -1.0)
        tree = grow(bins, n_0 + n_1, n_1 * at_1 + n_0 * at_0, n_1 * at_1 ** 2 + n_0 * at_0 ** 2, max(p[1] for p in same), min(p[2] for p in same))
        pruned = sorted(((inner(tree, depth, gain), (i, depth, gain)) for i, depth, gain in same), key=lambda x: x[0])
        for nodes, part in groupby(pruned, key=lambda x: x[0]):
            todo.append((done + 1, scores + (step if done else 1.0) * _leaf_values(tree, nodes, bins), [p for _, p in part]))


def grow(bins, n, total, squares, depth: int, least_gain: float) -> dict[int, tuple]:
    """Nodes by number (children of v are 2v and 2v + 1): (mean, feature, last bin of the left side, gain); a leaf has gain 0."""
    tree = {1: (total.sum() / n.sum(), 0, 0, 0.0)}
    node = np.ones(len(n), np.int64)
    for level in range(depth):
        open_nodes = [v for v in np.unique(node[n > 0]).tolist() if v in tree and v >= 1 << level]
        best: dict[int, tuple] = {}
        place = np.full(int(node.max()) + 1, -1)
        place[open_nodes] = range(len(open_nodes))
        at = place[node]
        inside = np.flatnonzero(at >= 0)
        for feature, b in enumerate(bins):
            width = int(b.max()) + 1
            index = at[inside] * width + b[inside]
            sums = [np.bincount(index, x[inside], len(open_nodes) * width).reshape(-1, width) for x in (n, total, squares)]
            whole, left = [x.sum(1, keepdims=True) for x in sums], [x.cumsum(1) for x in sums]
            right = [w - x for w, x in zip(whole, left)]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = _variance(*whole) - left[0] / whole[0] * _variance(*left) - right[0] / whole[0] * _variance(*right)
            gain[(left[0] < 1) | (right[0] < 1)] = -np.inf
            for k, last in enumerate(gain.argmax(1)):
                if gain[k, last] > best.get(k, (0.0,))[0]:
                    best[k] = (gain[k, last], feature, int(last), left[1][k, last] / left[0][k, last], right[1][k, last] / right[0][k, last])
        for k, (gain, feature, last, on_left, on_right) in best.items():
            if gain >= least_gain:
                v = open_nodes[k]
                tree[v] = (tree[v][0], feature, last, gain)
                tree[2 * v], tree[2 * v + 1] = (on_left, 0, 0, 0.0), (on_right, 0, 0, 0.0)
                here = np.flatnonzero(at == k)
                node[here] = 2 * v + (bins[feature][here] > last)
    return tree


def _variance(n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> np.ndarray:
    return np.where(n > 0, (squares - total * total / n) / n, 0.0)


def inner(tree: dict[int, tuple], depth: int, least_gain: float) -> tuple[int, ...]:
    """Nodes that stay cut at a depth and least gain."""
    kept: list[int] = []
    for v in sorted(tree):
        if tree[v][3] > 0 and tree[v][3] >= least_gain and v.bit_length() <= depth and (v == 1 or v // 2 in kept):
            kept.append(v)
    return tuple(kept)


def _leaf_values(tree: dict[int, tuple], nodes: tuple[int, ...], bins) -> np.ndarray:
    node = np.ones(len(bins[0]), np.int64)
    for v in nodes:  # parents come before their children
        here = np.flatnonzero(node == v)
        node[here] = 2 * v + (bins[tree[v][1]][here] > tree[v][2])
    values = np.zeros(max(tree) + 1)
    values[list(tree)] = [x[0] for x in tree.values()]
    return values[node]


def weighted_f1(tp: int, fp: int, tn: int, fn: int) -> float:
    """As ``MulticlassClassificationEvaluator`` gives it; 0 without rows."""
    n, one, zero = tp + fp + tn + fn, 2 * tp + fp + fn, 2 * tn + fp + fn
    return ((tp + fn) * (2 * tp / one if one else 0.0) + (tn + fp) * (2 * tn / zero if zero else 0.0)) / n if n else 0.0
