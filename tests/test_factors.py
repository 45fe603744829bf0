"""Factors against numpy and Spark's own fit; best items against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewscope.models import best_items, factors, recommender
from reviewscope.operators import lookup


@pytest.fixture(scope="module")
def rated(spark):
    """User 0 gives more than a third of the ratings, business 0 gets many."""
    pick = random.Random(2)
    rows = []
    for i in range(1_500):
        user, item = 0 if i % 5 < 2 else pick.randrange(1, 40), 0 if pick.random() < 0.2 else pick.randrange(1, 25)
        rows.append((i, user, item, float((user + item) % 2) + pick.random() / 10))
    rows += [(1500, None, 1, 1.0), (1501, 1, None, 1.0), (1502, 1, 1, None)]
    return spark.createDataFrame(rows, "review_id int, user_id int, business_id int, label double")


def by_id(table, rank):
    return {r["id"]: np.array([r[f"f_{i}"] for i in range(rank)]) for r in table.collect()}


def numpy_half_step(rows, known, rank, reg, side):
    sums = {}
    for user, item, label in rows:
        mine, other = (user, item) if side == 0 else (item, user)
        f = known[other]
        g, b, n = sums.get(mine, (np.zeros((rank, rank)), np.zeros(rank), 0))
        sums[mine] = g + np.outer(f, f), b + label * f, n + 1
    return {k: np.linalg.solve(g + reg * n * np.eye(rank), b) for k, (g, b, n) in sums.items()}


def close(a, b, digits=6):
    assert a.keys() == b.keys()
    assert max(np.abs(a[k] - b[k]).max() for k in a) < 10**-digits


@pytest.mark.parametrize("rank", [1, 4])
def test_factors_equal_numpy(spark, rated, rank, monkeypatch):
    rows = [tuple(r)[1:] for r in rated.na.drop().collect()]
    spark_users = {u for u, _, _ in rows}
    start = spark.createDataFrame([(u,) for u in spark_users], "id int").select(
        "id", *[factors.start_factor("id", i).alias(f"f_{i}") for i in range(rank)])
    users, items = by_id(start, rank), None
    for _ in range(2):
        items = numpy_half_step(rows, users, rank, 0.1, 1)
        users = numpy_half_step(rows, items, rank, 0.1, 0)
    for small in (lookup.SMALL_LOOKUP_ROWS, 0):  # factors broadcast, or shuffled with hot ids apart
        monkeypatch.setattr(lookup.lookup_join, "__defaults__", (small, None))
        model = factors.fit_factors(rated, rank=rank, iterations=2)
        close(by_id(model.users, rank), users)
        close(by_id(model.items, rank), items)


def test_a_half_step_gives_back_spark_factors(spark, rated):
    train = rated.na.drop()
    fitted = recommender.fit_als(train, "review_id", rank=4, maxIter=3, regParam=0.1)
    columns = [F.col("features")[i].cast("double").alias(f"f_{i}") for i in range(4)]
    items, users = fitted.itemFactors.select("id", *columns), fitted.userFactors.select("id", *columns)
    counts = train.groupBy(F.col("business_id").alias("id")).agg(F.count("*").alias("n_ratings"))
    ours = factors.half_step(train, "user_id", "business_id", "label", items, counts, 4, 0.1)
    close(by_id(ours, 4), by_id(users, 4), 4)


def test_scores_and_unknown_ids(spark, rated):
    model = factors.fit_factors(rated, rank=2, iterations=1)
    users, items = by_id(model.users, 2), by_id(model.items, 2)
    pairs = spark.createDataFrame([(0, 0), (1, 3), (0, 0), (999, 1), (1, 999), (None, 1)], "user_id int, business_id int")
    got = [(r["user_id"], r["business_id"], r["prediction"]) for r in factors.score_pairs(model, pairs).collect()]
    assert len(got) == 6
    for user, item, score in got:
        if user in users and item in items:
            assert abs(score - users[user] @ items[item]) < 1e-9
        else:
            assert score is None


def test_no_ratings(spark):
    empty = spark.createDataFrame([], "user_id int, business_id int, label double")
    model = factors.fit_factors(empty, rank=2, iterations=1)
    assert model.users.collect() == [] and model.items.collect() == []
    assert best_items.best_items(model, 3).table.collect() == []


def brute_force(users, items, k):
    out = []
    for u, x in users.items():
        scores = sorted((-(0.0 + x[0] * y[0] + x[1] * y[1] + x[2] * y[2]), i) for i, y in items.items())[:k]  # sum() would compensate rounding
        out += [(u, i, -s, r + 1) for r, (s, i) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 7, 1000])
def test_best_items_equal_all_pairs(spark, k):
    pick = random.Random(k)
    items = {i: [pick.randint(-3, 3) / (1 + i // 40) for _ in range(3)] for i in range(600)}  # small whole parts: many ties
    users = {u: [pick.randint(-2, 2) for _ in range(3)] for u in range(80)}  # some are all zero

    def table(d):
        return spark.createDataFrame([(i, *map(float, v)) for i, v in d.items()], "id long, f_0 double, f_1 double, f_2 double")

    found = best_items.best_items(factors.FactorModel(table(users), table(items), 3), k, first_band=32)
    want = brute_force({u: list(map(float, v)) for u, v in users.items()}, {i: list(map(float, v)) for i, v in items.items()}, k)
    assert sorted(map(tuple, found.table.collect())) == [(u, i, s, r) for u, i, s, r in want]
    if k < 10:
        assert found.compared < 0.5 * len(users) * len(items)


def test_fitted_factors_follow_taste(spark, rated):
    model = factors.fit_factors(rated, rank=3, iterations=6, reg=0.01)
    scored = factors.score_pairs(model, rated.na.drop().where("user_id > 0"))
    error = scored.agg(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2))).first()[0]
    assert error < 0.2
