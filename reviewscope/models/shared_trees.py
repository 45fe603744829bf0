"""A grid of decision trees, cross-validated in shared passes over the rows.

One tree is grown per number of bins and fold (and one on all rows), all of them level by level side by side: a pass
counts labels per tree, node, feature and bin, and the best cut of every node comes from those counts. Smaller depths
are the upper levels of the same tree, larger least gains are prunings of it, and folds are keys of the counts. So a
grid of b numbers of bins, d depths, g gains and k folds takes (largest depth + 1) passes instead of
b * d * g * (k + 1) fits of depth passes each.

Splits are ``value <= threshold`` with the largest Gini gain; equal gains go to the first feature, then to the lowest
threshold. A leaf predicts its majority, 0 if there is none. Thresholds are exact quantiles of all rows' values.

Edge cases: rows without a label are left out; a NULL feature lies below every threshold, NaN above; a NULL key is in fold 0;
without rows all counts are 0 and the score is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewscope.operators.ordering import PART, POS, block_totals, stage_in_order
from reviewscope.session import materialize


@dataclass
class Node:
    """Rows and positive rows; for an inner node also its cut: feature number, last bin of the left side, gain in billionths."""

    n: int = 0
    positive: int = 0
    feature: int | None = None
    last: int = 0
    gain: int = 0


Tree = dict[int, Node]  # by number: the root is 1, the children of v are 2v and 2v + 1


@dataclass
class Grid:
    """``trees`` by (number of bins, fold left out); ``table`` has one row per grid point and fold."""

    trees: dict[tuple[int, int], Tree]
    thresholds: dict[int, list[list[float]]]
    table: DataFrame
    best: dict[str, float] | None
    passes: int
    features: list[str] = field(default_factory=list)

    def predict(self, rows: DataFrame, max_bins: int, max_depth: int, min_gain: float) -> DataFrame:
        """``rows`` with the prediction of the tree on all rows, cut back to a grid point."""
        tree = self.trees[max_bins, -1]
        bins = [bin_of(F.col(c), cuts) for c, cuts in zip(self.features, self.thresholds[max_bins])]
        shown = {v: x if _kept(tree, v, max_depth, min_gain) else Node(x.n, x.positive) for v, x in tree.items()}
        return rows.withColumn("prediction", _walk(shown, bins, lambda v: F.lit(_majority(shown, v))))


def fold_of(key: Column, folds: int) -> Column:
    return F.coalesce(F.conv(F.substring(F.md5(key.cast("string")), 1, 4), 16, 10).cast("bigint") % folds, F.lit(0)).cast("int")


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """Number of thresholds below the value."""
    total = F.lit(0)
    for cut in cuts:
        total = total + F.when(value > cut, 1).otherwise(0)
    return total


def quantile_thresholds(rows: DataFrame, features: Sequence[str], max_bins: Sequence[int]) -> dict[int, list[list[float]]]:
    """Per number of bins and feature the sorted values that end a bin, none of them the largest value.

    With N values in order, bin i of b ends at the first value that i * N / b values do not exceed. Values are counted
    and range sorted; only the thresholds, at most b - 1 per feature, reach the driver.
    """
    counts = (
        rows.select([F.col(c).cast("double").alias(str(i)) for i, c in enumerate(features)])
        .unpivot([], [str(i) for i in range(len(features))], "feature", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("feature", "value").agg(F.count("*").alias("n"))
    )
    staged = stage_in_order(counts, "feature", "value", name="values")
    totals = block_totals(staged, ["feature"], F.col("n"))
    inside = Window.partitionBy("feature", PART).orderBy(POS)
    places = staged.join(F.broadcast(totals), ["feature", PART]).select(
        "feature", "value", "n", "group_total", (F.col("before") + F.sum("n").over(inside)).alias("upto"))
    ends = F.array(*[
        F.when(F.floor((F.col("upto") - F.col("n")) * b / F.col("group_total")) < F.floor(F.col("upto") * b / F.col("group_total")), b)
        for b in max_bins])
    found = (
        places.where(F.col("upto") < F.col("group_total"))
        .select("feature", "value", F.explode(ends).alias("b")).where(F.col("b").isNotNull()).collect()
    )
    return {b: [sorted(r["value"] for r in found if r["b"] == b and r["feature"] == str(i)) for i in range(len(features))]
            for b in max_bins}


def cross_validate(
    rows: DataFrame, key: str, label: str, features: Sequence[str], max_bins: Sequence[int], max_depths: Sequence[int],
    min_gains: Sequence[float] = (0.0,), folds: int = 5,
) -> Grid:
    """Confusion counts and weighted F1 of every grid point on every fold, and the point of the best mean F1."""
    spark, features = rows.sparkSession, list(features)
    rows = rows.where(F.col(label).isNotNull())
    thresholds = quantile_thresholds(rows, features, max_bins)
    binned = materialize(rows.select(
        fold_of(F.col(key), folds).alias("fold"), F.col(label).cast("int").alias("label"),
        *[F.coalesce(bin_of(F.col(c).cast("double"), cuts), F.lit(0)).cast("short").alias(_name(b, i))
          for b in max_bins for i, (c, cuts) in enumerate(zip(features, thresholds[b]))],
    ), "binned")
    trees: dict[tuple[int, int], Tree] = {(b, f): {} for b in max_bins for f in range(-1, folds)}
    passes = 0
    for level in range(max(max_depths)):
        passes += 1
        cuts = best_cuts(_level_counts(binned, trees, len(features), level)).collect()
        for cut in cuts:
            tree, v = trees[cut["b"], cut["left_out"]], cut["node"]
            tree[v] = Node(cut["n"], cut["positive"])
            if cut["gain"] > 0:
                tree[v] = Node(cut["n"], cut["positive"], cut["feature"], cut["last"], cut["gain"])
                tree[2 * v] = Node(cut["n_left"], cut["positive_left"])
                tree[2 * v + 1] = Node(cut["n"] - cut["n_left"], cut["positive"] - cut["positive_left"])
        if not any(cut["gain"] > 0 for cut in cuts):
            break
    passes += 1
    leaves = _leaf_counts(binned, trees, len(features), max_bins, folds).collect()
    scores = [
        (b, d, float(g), f, *_confusion(trees[b, f], [x for x in leaves if x["b"] == b and x["fold"] == f], d, g))
        for b in max_bins for d in max_depths for g in min_gains for f in range(folds)
    ]
    table = spark.createDataFrame(
        [(*row, weighted_f1(*row[4:])) for row in scores],
        "max_bins int, max_depth int, min_gain double, fold int, tp bigint, fp bigint, tn bigint, fn bigint, f1 double")
    return Grid(trees, thresholds, table, _best(scores), passes, features)


def _name(b: int, feature: int) -> str:
    return f"b{b}_{feature}"


def _walk(tree: Tree, bins: Sequence[Column], shown, v: int = 1) -> Column:
    node = tree.get(v)
    if node is None or node.feature is None:
        return shown(v)
    return F.when(bins[node.feature] <= node.last, _walk(tree, bins, shown, 2 * v)).otherwise(_walk(tree, bins, shown, 2 * v + 1))


def _level_counts(binned: DataFrame, trees: dict[tuple[int, int], Tree], n_features: int, level: int) -> DataFrame:
    """Rows and positive rows per tree, node of ``level``, feature and bin.

    Counted ahead of the shuffle; the number of groups depends on the trees, not on the rows.
    """
    places = []
    for (b, left_out), tree in trees.items():
        bins = [F.col(_name(b, i)) for i in range(n_features)]
        places.append(F.struct(F.lit(b).alias("b"), F.lit(left_out).alias("left_out"), _walk(tree, bins, F.lit).alias("node"),
                               F.array(*bins).alias("bins")))
    open_nodes = binned.select("fold", "label", F.explode(F.array(*places)).alias("t")).where(
        (F.col("t.left_out") != F.col("fold")) & (F.col("t.node") >= 1 << level))
    return (
        open_nodes.select("label", "t.b", "t.left_out", "t.node", F.posexplode("t.bins").alias("feature", "bin"))
        .groupBy("b", "left_out", "node", "feature", "bin")
        .agg(F.count("*").alias("n"), F.sum("label").alias("positive"))
    )


def _gini(positive: Column, n: Column) -> Column:
    share = F.try_divide(positive.cast("double"), n)
    return 2.0 * share * (1.0 - share)


def best_cuts(counts: DataFrame) -> DataFrame:
    """One row per node: its counts and the cut of the largest gain (in whole billionths, so that equal cuts tie);
    the gain is 0 where nothing can be cut off."""
    node = ["b", "left_out", "node"]
    along = Window.partitionBy(*node, "feature").orderBy("bin")
    whole = Window.partitionBy(*node, "feature")
    sides = counts.select(
        *node, "feature", F.col("bin").alias("last"),
        F.sum("n").over(along).alias("n_left"), F.sum("positive").over(along).alias("positive_left"),
        F.sum("n").over(whole).alias("n"), F.sum("positive").over(whole).alias("positive"))
    n_right, positive_right = F.col("n") - F.col("n_left"), F.col("positive") - F.col("positive_left")
    gain = (
        _gini(F.col("positive"), F.col("n")) - F.col("n_left").cast("double") / F.col("n") * _gini(F.col("positive_left"), F.col("n_left"))
        - n_right.cast("double") / F.col("n") * _gini(positive_right, n_right)
    )
    scored = sides.withColumn("gain", F.when(n_right > 0, F.floor(gain * 1e9)).otherwise(0).cast("bigint"))
    best = Window.partitionBy(*node).orderBy(F.desc("gain"), "feature", "last")
    return scored.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")


def _leaf_counts(binned: DataFrame, trees: dict[tuple[int, int], Tree], n_features: int, max_bins: Sequence[int], folds: int) -> DataFrame:
    """Rows and positive rows of each fold per leaf of the tree that has not seen the fold."""
    places = []
    for b in max_bins:
        bins = [F.col(_name(b, i)) for i in range(n_features)]
        leaf = F.lit(1)
        for f in range(folds):
            leaf = F.when(F.col("fold") == f, _walk(trees[b, f], bins, F.lit)).otherwise(leaf)
        places.append(F.struct(F.lit(b).alias("b"), leaf.alias("node")))
    return (
        binned.select("fold", "label", F.explode(F.array(*places)).alias("t"))
        .groupBy("fold", "t.b", "t.node").agg(F.count("*").alias("n"), F.sum("label").alias("positive"))
    )


def _kept(tree: Tree, v: int, max_depth: int, min_gain: float) -> bool:
    """Whether the cut at ``v`` is left at a grid point: its depth and all gains down to it allow it."""
    while v:
        if tree[v].feature is None or v.bit_length() > max_depth or tree[v].gain < min_gain * 1e9:
            return False
        v //= 2
    return True


def _majority(tree: Tree, v: int) -> int:
    node = tree.get(v) or Node()
    return int(2 * node.positive > node.n)


def _confusion(tree: Tree, leaves: list, max_depth: int, min_gain: float) -> tuple[int, int, int, int]:
    tp = fp = tn = fn = 0
    for leaf in leaves:
        v = leaf["node"]
        while v > 1 and not _kept(tree, v // 2, max_depth, min_gain):
            v //= 2
        if _majority(tree, v):
            tp, fp = tp + leaf["positive"], fp + leaf["n"] - leaf["positive"]
        else:
            fn, tn = fn + leaf["positive"], tn + leaf["n"] - leaf["positive"]
    return tp, fp, tn, fn


def weighted_f1(tp: int, fp: int, tn: int, fn: int) -> float | None:
    """F1 of both classes, weighted by their rows; a class that is never hit has 0."""
    n = tp + fp + tn + fn
    if not n:
        return None
    one, zero = 2 * tp + fp + fn, 2 * tn + fp + fn
    score = (tp + fn) * (2 * tp / one if one else 0.0) + (tn + fp) * (2 * tn / zero if zero else 0.0)
    return round(score / n, 9)


def _best(scores: list[tuple]) -> dict[str, float] | None:
    """Highest mean F1 over the folds that hold rows; the first such point in grid order."""
    points: dict[tuple, list[float]] = {}
    for b, d, g, _, *counts in scores:
        value = weighted_f1(*counts)
        if value is not None:
            points.setdefault((b, d, g), []).append(value)
    if not points:
        return None
    means = {point: sum(x) / len(x) for point, x in points.items()}
    b, d, g = max(means, key=means.get)
    return {"max_bins": b, "max_depth": d, "min_gain": g, "f1": means[b, d, g]}
