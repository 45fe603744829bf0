"""Alternating least squares from partial sums, for raters and businesses of any size.

Of every rating only its share of two sums is needed: the products of the other side's
factors (a symmetric matrix) and those factors times the label. Both are plain sums per id,
so they are added up before anything moves: a user with a third of all ratings is one row
per task, and no task ever holds the list of one user's ratings. The joins that bring factors to
the ratings spread hot ids. Each id's small linear system is solved by Cholesky steps in
built-in expressions.

Like in Spark's ALS the penalty grows with the number of ratings of an id. Start factors are
hashes of the id, so equal input gives equal factors up to the order of sums, for any layout.

Edge cases: rows with a NULL id or label are left out; repeated pairs count as often as they
occur; an id without ratings has no factors; an empty table gives empty factor tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewscope.operators.lookup import lookup_join
from reviewscope.session import materialize

SEED = 42


@dataclass
class FactorModel:
    """Factor tables (id, f_0, f_1, ...) of both sides."""

    users: DataFrame
    items: DataFrame
    rank: int


def factor_columns(rank: int) -> list[str]:
    return [f"f_{i}" for i in range(rank)]


def start_factor(key: Column | str, i: int, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id, the factor's number and the seed."""
    text = F.concat_ws(":", F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(f"{i}:{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _solve(sums: DataFrame, rank: int, reg: float) -> DataFrame:
    """(id, f_i) from the sums g_i_j, b_i and n: one Cholesky column per projection, then both substitutions."""
    out = sums
    for j in range(rank):
        pivot = F.col(f"g_{j}_{j}") + reg * F.col("n")
        for k in range(j):
            pivot = pivot - F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}")
        out = out.withColumn(f"l_{j}_{j}", F.sqrt(pivot))
        below = {}
        for i in range(j + 1, rank):
            value = F.col(f"g_{j}_{i}")
            for k in range(j):
                value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            below[f"l_{i}_{j}"] = value / F.col(f"l_{j}_{j}")
        right = F.col(f"b_{j}")
        for k in range(j):
            right = right - F.col(f"l_{j}_{k}") * F.col(f"y_{k}")
        out = out.withColumns({**below, f"y_{j}": right / F.col(f"l_{j}_{j}")})
    for j in reversed(range(rank)):
        value = F.col(f"y_{j}")
        for k in range(j + 1, rank):
            value = value - F.col(f"l_{k}_{j}") * F.col(f"f_{k}")
        out = out.withColumn(f"f_{j}", value / F.col(f"l_{j}_{j}"))
    return out.select("id", *factor_columns(rank))


def normal_sums(ratings: DataFrame, solve_for: str, known: str, label: str, factors: DataFrame, counts: DataFrame, rank: int) -> DataFrame:
    """Per id of ``solve_for``: the factor products g_i_j (i <= j), b_i and the number n of its ratings.

    ``counts`` has the number of ratings of each known id, by which hot ones are told.
    """
    names = factor_columns(rank)
    lookup = factors.join(counts, "id").withColumnRenamed("id", known)
    rated = lookup_join(ratings.select(solve_for, known, label), lookup, [known], "n_ratings", [solve_for, label])
    products = [
        F.sum(F.col(names[i]) * F.col(names[j])).alias(f"g_{i}_{j}") for i in range(rank) for j in range(i, rank)
    ]
    rights = [F.sum(F.col(names[i]) * F.col(label)).alias(f"b_{i}") for i in range(rank)]
    return rated.groupBy(F.col(solve_for).alias("id")).agg(F.count("*").alias("n"), *products, *rights)


def half_step(ratings: DataFrame, solve_for: str, known: str, label: str, factors: DataFrame, counts: DataFrame, rank: int, reg: float) -> DataFrame:
    """The best factors of one side while the other side's stay as they are, written as a table."""
    sums = normal_sums(ratings, solve_for, known, label, factors, counts, rank)
    return materialize(_solve(materialize(sums, "normal-sums"), rank, reg), f"factors-{solve_for}")


def fit_factors(
    ratings: DataFrame, user: str = "user_id", item: str = "business_id", label: str = "label",
    rank: int = 10, iterations: int = 10, reg: float = 0.1, seed: int = SEED,
) -> FactorModel:
    """Factors of users and items; each round solves the items first and the users last."""
    rows = ratings.select(user, item, F.col(label).cast("double").alias(label)).na.drop()
    rows = materialize(rows, "ratings")
    counts = {
        side: materialize(rows.groupBy(F.col(side).alias("id")).agg(F.count("*").alias("n_ratings")), "rating-counts")
        for side in (user, item)
    }
    users = counts[user].select("id", *[start_factor("id", i, seed).alias(c) for i, c in enumerate(factor_columns(rank))])
    items = None
    for _ in range(iterations):
        items = half_step(rows, item, user, label, users, counts[user], rank, reg)
        users = half_step(rows, user, item, label, items, counts[item], rank, reg)
    return FactorModel(users, items, rank)


def score_pairs(model: FactorModel, pairs: DataFrame, user: str = "user_id", item: str = "business_id") -> DataFrame:
    """``pairs`` with a ``prediction``; NULL where an id is unknown. Hot ids are spread."""
    out = pairs
    for side, factors, prefix in ((user, model.users, "u_"), (item, model.items, "i_")):
        names = {c: f"{prefix}{c}" for c in factor_columns(model.rank)}
        counts = pairs.groupBy(side).agg(F.count("*").alias("_pairs"))
        lookup = factors.withColumnsRenamed({"id": side, **names}).join(counts, side)
        out = lookup_join(out, lookup, [side], "_pairs", pairs.columns)
    score = F.lit(0.0)
    for c in factor_columns(model.rank):
        score = score + F.col(f"u_{c}") * F.col(f"i_{c}")
    return out.select(*pairs.columns, score.alias("prediction"))
