"""Trees of a grid grown side by side, against single fits, recursion in Python and Spark ML."""

import hashlib
import random

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler

from reviewscope.models import shared_trees as st

BINS, DEPTHS, GAINS, FOLDS = [3, 40], [1, 3], [0.0, 0.01], 4
SCHEMA = "k string, y int, fold double, label double"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for i in range(400):
        a, b = rng.randrange(8), rng.choice([0.5, 1.5, 2.5, None])
        out.append((str(i), int(rng.random() < (0.9 if a > 4 and b != 0.5 else 0.2)), float(a), b))
    return out + out[:5]


def _fold(key):
    return int(hashlib.md5(key.encode()).hexdigest()[:4], 16) % FOLDS


def _cuts(values, bins):
    values = sorted(v for v in values if v is not None)
    n = len(values)
    upto = {v: i + 1 for i, v in enumerate(values)}
    cuts, before = [], 0
    for v in sorted(upto):
        if upto[v] < n and before * bins // n < upto[v] * bins // n:
            cuts.append(v)
        before = upto[v]
    return cuts


def _gini(part):
    share = sum(y for _, y in part) / len(part)
    return 2.0 * share * (1.0 - share)


def _grow(part, depth, least):
    """A tree over (bins, label) pairs as nested tuples."""
    best = (0, None)
    for f in range(2) if depth else ():
        for last in sorted({x[f] for x, _ in part}):
            left, right = [r for r in part if r[0][f] <= last], [r for r in part if r[0][f] > last]
            if right:
                gain = _gini(part) - len(left) / len(part) * _gini(left) - len(right) / len(part) * _gini(right)
                if int(gain * 1e9) > best[0]:
                    best = (int(gain * 1e9), (f, last, left, right))
    if best[1] is None or best[0] < least * 1e9:
        return int(2 * sum(y for _, y in part) > len(part))
    f, last, left, right = best[1]
    return f, last, _grow(left, depth - 1, least), _grow(right, depth - 1, least)


def _say(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def test_equals_single_fits_in_python(spark, rows):
    grid = st.cross_validate(spark.createDataFrame(rows, SCHEMA), "k", "y", ["fold", "label"], BINS, DEPTHS, GAINS, FOLDS)
    assert grid.passes == max(DEPTHS) + 1
    got = {tuple(r)[:4]: tuple(r)[4:8] for r in grid.table.collect()}
    assert len(got) == len(BINS) * len(DEPTHS) * len(GAINS) * FOLDS
    for b in BINS:
        cuts = [_cuts([r[i] for r in rows], b) for i in (2, 3)]
        binned = [(_fold(r[0]), tuple(sum(c < v for c in cut) if v is not None else 0 for v, cut in zip(r[2:], cuts)), r[1]) for r in rows]
        for d in DEPTHS:
            for g in GAINS:
                for f in range(FOLDS):
                    tree = _grow([(x, y) for k, x, y in binned if k != f], d, g)
                    told = [(_say(tree, x), y) for k, x, y in binned if k == f]
                    assert got[b, d, g, f] == tuple(told.count(x) for x in [(1, 1), (1, 0), (0, 0), (0, 1)])
    assert len(set(got.values())) > FOLDS and grid.best["f1"] > 0.7


def test_one_point_alone_gives_the_same(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    many = st.cross_validate(df, "k", "y", ["fold", "label"], BINS, DEPTHS, GAINS, FOLDS)
    alone = st.cross_validate(df.repartition(7), "k", "y", ["fold", "label"], [40], [1], [0.01], FOLDS)
    same = many.table.where("max_bins = 40 and max_depth = 1 and min_gain = 0.01")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, alone.table.collect()))


def test_predictions_equal_spark_ml(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        a, b, c = rng.randrange(6), rng.randrange(5), rng.randrange(4)
        rows.append((i, int(rng.random() < 0.1 + 0.13 * a - 0.05 * b + 0.1 * (c == 2)), float(a), float(b), float(c)))
    df = spark.createDataFrame(rows, "k int, y int, a double, b double, c double")
    names = ["a", "b", "c"]
    grid = st.cross_validate(df, "k", "y", names, [32], [2], folds=3)
    ours = {r["k"]: r["prediction"] for r in grid.predict(df, 32, 2, 0.0).collect()}
    assembled = VectorAssembler(inputCols=names, outputCol="x").transform(df)
    model = DecisionTreeClassifier(featuresCol="x", labelCol="y", maxDepth=2, maxBins=32).fit(assembled)
    theirs = {r["k"]: int(r["prediction"]) for r in model.transform(assembled).collect()}
    assert ours == theirs and set(ours.values()) == {0, 1}


def test_odd_tables(spark):
    def told(rows):
        grid = st.cross_validate(spark.createDataFrame(rows, SCHEMA), "k", "y", ["fold", "label"], [4], [2], folds=2)
        return grid, [tuple(r)[3:] for r in grid.table.orderBy("fold").collect()]

    grid, empty = told([])
    assert empty == [(0, 0, 0, 0, 0, None), (1, 0, 0, 0, 0, None)] and grid.best is None
    assert grid.predict(spark.createDataFrame([("x", 1, 1.0, 1.0)], SCHEMA), 4, 2, 0.0).first()["prediction"] == 0
    _, unlabelled = told([("a", None, 1.0, 2.0)] * 3)
    assert unlabelled == empty
    _, one_class = told([(None, 1, None, None)] * 4 + [("a", 1, 1.0, float("nan"))] * 3 + [("b", 1, 2.0, 5.0)] * 3)
    assert sum(sum(r[1:5]) for r in one_class) == 10 and all(r[2] == r[3] == 0 for r in one_class)
