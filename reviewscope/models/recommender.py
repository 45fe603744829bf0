"""Collaborative filtering with alternating least squares."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewscope.functions.numbers import is_number, round_abs
from reviewscope.models.frames import kept_rows, stable_order
from reviewscope.session import checkpoint_root

SEED = 42


def als(**settings) -> ALS:
    """User x business -> label.

    Rows with an unseen id are dropped from scored frames. Otherwise one such
    row would turn every tuning metric into NaN.
    """
    settings = {"seed": SEED, "coldStartStrategy": "drop", **settings}
    return ALS(userCol="user_id", itemCol="business_id", ratingCol="label", **settings)


def merge_repeats(train: DataFrame) -> DataFrame:
    """One row per user and business with the mean label.

    Spark's ALS keeps all ratings of one user in one task. Where single users
    rate the same businesses over and over, merging bounds that list by the
    number of businesses. Repeats then weigh as one rating.
    """
    return train.groupBy("user_id", "business_id").agg(F.avg("label").alias("label"))


def fit_als(train: DataFrame, key: str, merge: bool = False, **settings) -> ALSModel:
    """Fit on the rating rows; ``key`` must be unique so that reruns see the same order.

    ``merge`` first merges repeated ratings (see ``merge_repeats``), for data in
    which single users or businesses hold a large share of all ratings.
    """
    checkpoint_root(train.sparkSession)  # ALS cuts its lineage there every 10 rounds
    if merge:
        train, key = merge_repeats(train).withColumn("_pair", F.struct("user_id", "business_id")), "_pair"
    with kept_rows(stable_order(train, key)) as rows:
        return als(**settings).fit(rows)


def score_all(model: ALSModel, test: DataFrame) -> DataFrame:
    """All test rows; those with an unseen id keep a NaN score, so that coverage can be reported."""
    return model.copy({model.coldStartStrategy: "nan"}).transform(test)


def scored_and_rounded(model: ALSModel, test: DataFrame) -> DataFrame:
    """Scores of the test rows, unusable ones removed, rounded to a whole positive number."""
    scored = score_all(model, test).where(is_number(F.col("prediction")))
    return scored.withColumn("prediction", round_abs(F.col("prediction").cast("double")))


def top_items(model: ALSModel, k: int) -> DataFrame:
    """The ``k`` businesses with the highest score for every user, equal scores by the lower id.

    Spark's blocked search does the work, whatever the number of businesses. Of
    businesses that tie for the last place it keeps any.
    """
    found = model.recommendForAllUsers(k)
    by_score = F.array_sort(F.transform("recommendations", lambda r: F.struct(
        (-r["rating"]).alias("minus"), r["business_id"].alias("business_id"),
    )))
    ranked = found.select("user_id", F.posexplode(by_score).alias("place", "r"))
    return ranked.select(
        "user_id", F.col("r.business_id").alias("business_id"), (-F.col("r.minus")).alias("score"),
        (F.col("place") + 1).alias("rank"),
    )
