import math
import random
from functools import cache

import numpy as np
import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from reviewscope.models import frames, recommender, sentiment, trees, tuning
from reviewscope.operators import evaluate, slices
from reviewscope.plans import standin


def report(scored):
    return {r["metric"]: r["value"] for r in evaluate.classifier_report(scored).collect()}


@pytest.fixture(scope="module")
def id_rows(spark):
    """The label follows the business with some noise; other ids say nothing."""
    pick = random.Random(11)
    rows = []
    for i in range(1_500):
        business = pick.random()
        rows.append((i, pick.random(), pick.random(), business, float((business > 0.4) ^ (pick.random() < 0.1))))
    return spark.createDataFrame(rows, "row_id int, user_id double, review_id double, business_id double, label double")


def test_text_model_beats_the_majority(spark):
    train, test = slices.train_test(standin.labelled_texts(spark, "/root/testdata/sf0.01"), "doc_id")
    got = report(sentiment.fit_sentiment(train, "doc_id").transform(test))
    assert got["F1 weighted"] > 0.89 > got["F1 weighted, majority class"]


@pytest.mark.parametrize("build", [trees.tree_pipeline, trees.boosted_pipeline, trees.forest_pipeline])
def test_trees_find_a_planted_signal_and_repeat(id_rows, build):
    train, test = slices.train_test(id_rows, "row_id")
    results = []
    for parts in (1, 13):
        model = trees.fit_in_order(build(), train.repartition(parts), "row_id")
        scored = model.transform(test).select("row_id", "prediction", "trueLabel")
        results.append(sorted(map(tuple, scored.collect())))
    assert results[0] == results[1]
    got = report(scored)
    assert got["F1 weighted"] > 0.85 > got["F1 weighted, majority class"]


def test_multiclass_forest(id_rows):
    stars = id_rows.withColumn("label", F.floor(F.col("business_id") * 4.999).cast("double") + 1)
    train, test = slices.train_test(stars, "row_id")
    scored = trees.fit_in_order(trees.forest_pipeline(), train, "row_id").transform(test)
    assert scored.where("prediction = trueLabel").count() > 0.8 * scored.count()


def test_grids_have_the_published_sizes():
    tree, boosted = trees.tree_pipeline(), trees.boosted_pipeline()
    assert len(tuning.build_grid(tree, tuning.TREE_GRID)) == 6
    assert len(tuning.build_grid(boosted, tuning.BOOSTED_GRID)) == 144
    assert len(tuning.build_grid(recommender.als(), tuning.ALS_GRID)) == 8


def test_tuners_choose_the_deeper_tree(id_rows):
    middle = F.col("business_id").between(0.3, 0.7).cast("double")
    train, test = slices.train_test(id_rows.withColumn("label", middle), "row_id")
    grid = {"maxDepth": [1, 4]}
    by_split = tuning.tune_on_split(trees.tree_pipeline(), grid, tuning.weighted_f1(), train, "row_id")
    by_folds = tuning.tune_by_folds(trees.tree_pipeline(), grid, tuning.score_auc(), train, "row_id", folds=3)
    for model in (by_split, by_folds):
        points = tuning.grid_metrics(model)
        assert [p["maxDepth"] for p, _ in points] == [1, 4] and points[1][1] > points[0][1]
        assert model.bestModel.stages[-1].depth > 1
        assert report(model.transform(test))["F1 weighted"] > 0.95


@pytest.fixture(scope="module")
def taste(spark):
    """Users of two kinds like businesses of the same kind."""
    pick = random.Random(3)
    rows = [(i, pick.randrange(40), pick.randrange(30)) for i in range(1_600)]
    rows = [(i, u, b, float(u % 2 == b % 2)) for i, u, b in rows]
    return spark.createDataFrame(rows, "review_id int, user_id int, business_id int, label double")


def test_als_learns_repeats_and_reports_coverage(spark, taste):
    train, test = slices.train_test(taste, "review_id")
    model = recommender.fit_als(train, "review_id", rank=5, regParam=0.05)
    again = recommender.fit_als(train.repartition(9), "review_id", rank=5, regParam=0.05)
    shown = [sorted(map(tuple, recommender.scored_and_rounded(m, test).select("review_id", "prediction").collect()))
             for m in (model, again)]
    assert shown[0] == shown[1]
    stranger = spark.createDataFrame([(9_999, 999, 1, 1.0)], "review_id int, user_id int, business_id int, trueLabel double")
    got = evaluate.rating_report(recommender.score_all(model, test.unionByName(stranger))).first()
    assert got["n_rows"] - got["n_scored"] == 1 and got["rmse"] < 0.3


def test_als_tuning_is_finite(taste):
    train, _ = slices.train_test(taste, "review_id")
    grid = {"rank": [1, 4], "regParam": [0.05]}
    model = tuning.tune_on_split(recommender.als(maxIter=5), grid, tuning.label_rmse(), train, "review_id")
    metrics = [m for _, m in tuning.grid_metrics(model)]
    assert all(math.isfinite(m) for m in metrics) and metrics[1] < metrics[0]
    folds = tuning.tune_by_folds(recommender.als(maxIter=5), grid, tuning.label_rmse(), train, "review_id", folds=2)
    assert folds.bestModel.rank == 4


def test_als_tuning_without_a_scorable_row(spark):
    """Every user and business occurs once, so no validation row can be scored."""
    rows = [(i, i, i, float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "review_id int, user_id int, business_id int, label double")
    model = tuning.tune_on_split(recommender.als(maxIter=2), {"rank": [1, 2]}, tuning.label_rmse(), df, "review_id")
    assert [m for _, m in tuning.grid_metrics(model)] == [math.inf, math.inf] and model.bestModel.rank == 1
    scored = spark.createDataFrame([(float("nan"), 1.0), (0.5, 1.0), (1.0, 0.0)], "prediction double, label double")
    assert tuning.ScoredRmse.rmse_and_count(scored) == (pytest.approx(math.sqrt(0.625)), 2)


def test_validation_rows_depend_on_the_key_alone(spark):
    keys = spark.range(5_000).withColumnRenamed("id", "k")
    picked = [{r["k"] for r in part.where(tuning.in_validation_part("k")).collect()} for part in (keys.repartition(3), keys.coalesce(1))]
    assert picked[0] == picked[1] and 0.17 < len(picked[0]) / 5_000 < 0.23
    inside = keys.where(slices.in_training_part(F.col("k")))
    share = inside.where(tuning.in_validation_part("k")).count() / inside.count()
    assert 0.17 < share < 0.23


@pytest.mark.parametrize("rows", [9_999, 10_001])
def test_partitions_do_not_depend_on_the_row_count(spark, rows):
    placed = frames.stable_order(spark.range(rows).withColumnRenamed("id", "k"), "k")
    assert placed.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert frames.stable_order(spark.range(rows).withColumnRenamed("id", "k"), "k", 7).rdd.getNumPartitions() == 7


def test_top_items_in_order_of_score_then_id(taste):
    model = recommender.fit_als(taste, "review_id", rank=4)
    items = sorted((r["id"], r["features"]) for r in model.itemFactors.collect())
    matrix = np.array([f for _, f in items], dtype=np.float32)
    rows = recommender.top_items(model, 6).collect()
    users = model.userFactors.collect()
    assert len(rows) == 6 * len(users)
    for user in users:
        expected = sorted(matrix @ np.array(user["features"], dtype=np.float32), reverse=True)[:6]
        mine = sorted((r for r in rows if r["user_id"] == user["id"]), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5, 6]
        assert [r["score"] for r in mine] == pytest.approx(expected, abs=1e-5)
        assert all((a["score"], -a["business_id"]) > (b["score"], -b["business_id"]) for a, b in zip(mine, mine[1:]))


def test_ties_go_to_the_lower_id_and_few_items_are_all_listed(spark):
    rows = [(u * 5 + b, u, b, 1.0) for u in range(4) for b in range(5)]
    tied = spark.createDataFrame(rows, "review_id int, user_id int, business_id int, label double")
    shown = recommender.top_items(recommender.fit_als(tied, "review_id", rank=1), 9).collect()
    assert len(shown) == 20
    for a in shown:
        for b in shown:
            if a["user_id"] == b["user_id"] and a["score"] == b["score"] and a["rank"] < b["rank"]:
                assert a["business_id"] < b["business_id"]


def test_a_hot_user_can_be_merged(spark):
    rows = [(i, 1 if i % 3 else i, i % 7, float(i % 2)) for i in range(600)]
    df = spark.createDataFrame(rows, "review_id int, user_id int, business_id int, label double")
    model = recommender.fit_als(df, "review_id", merge=True, rank=2, maxIter=3)
    assert model.userFactors.count() == len({r[1] for r in rows}) and model.itemFactors.count() == 7


def test_merge_repeats(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 1, 1.0), (2, 1, 1.0)], "user_id int, business_id int, label double")
    assert sorted(map(tuple, recommender.merge_repeats(df).collect())) == [(1, 1, 0.5), (2, 1, 1.0)]


def test_hashed_words_show_their_buckets(spark):
    df = spark.createDataFrame([(["good", "food", "good"],), ([],)], "kept_words array<string>")
    stage = sentiment.text_stages()[-1]
    shown = stage.transform(df).select(sentiment.sparse_entries(F.col("features")).alias("e")).collect()
    expected = {stage.indexOf("good"): 2.0, stage.indexOf("food"): 1.0}
    assert {x["bucket"]: x["weight"] for x in shown[0]["e"]} == expected and shown[1]["e"] == []
    assert isinstance(stage, HashingTF) and stage.getNumFeatures() == 2 ** 18


def test_hashed_vectors_are_rebuilt_from_words(spark, sf_dir):
    stage = sentiment.text_stages()[-1]
    kept = sentiment.text_stages()[1].transform(sentiment.text_stages()[0].transform(standin.texts(spark, sf_dir)))
    for r in stage.transform(kept).select("kept_words", "features").collect():
        counts = {}
        for word in r["kept_words"]:
            bucket = _bucket(stage, word)
            counts[bucket] = counts.get(bucket, 0.0) + 1
        assert dict(zip(r["features"].indices.tolist(), r["features"].values.tolist())) == counts


@cache
def _bucket(stage, word):
    return stage.indexOf(word)


def test_frames(spark):
    df = spark.sql("select 3 user_id, 4 review_id, 5 business_id, 'x' text, 4 stars")
    assert frames.assembled_array(frames.id_frame(df)).first()["features"] == [3.0, 4.0, 5.0]
    assert tuple(frames.rating_frame(df).first()) == (3, 5, 1.0)
    assert tuple(frames.text_frame(df).first()) == ("x", 1.0)


def test_searches_on_few_rows_use_few_tasks_and_native_folds(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tuning, "stable_order", lambda df, key, n=None: (seen.append(n), frames.stable_order(df, key, n))[1])
    train = spark.range(400).select(F.col("id").alias("row_id"), *[(F.col("id") * k % 97).alias(c) for k, c in enumerate(frames.ID_FEATURES, 2)], (F.col("id") % 2).cast("double").alias("label"))
    model = tuning.tune_by_folds(trees.tree_pipeline(), {"maxDepth": [1, 2]}, tuning.score_auc(), train, "row_id", folds=2)
    assert seen == [1] and len(model.avgMetrics) == len(model.stdMetrics) == len(model.getEstimatorParamMaps()) == 2
    monkeypatch.setattr(frames, "ROWS_PER_PARTITION", 150)
    assert frames.search_partitions(train) == 3
