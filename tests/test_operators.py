"""Operators against plain Python on small frames, including hot keys and both join routes."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewscope.functions.text import clean_tokens, word_tokens
from reviewscope.operators import encode, slices, summarize, words
from reviewscope.operators.lookup import lookup_join


def skewed_rows(n=3_000, seed=1):
    """A third of all rows share one user, and some ids are missing."""
    pick = random.Random(seed)
    return [
        (i, None if pick.random() < 0.05 else "hot" if i % 3 == 0 else f"u{pick.randrange(700):03d}",
         f"b{pick.randrange(40)}", f"r{i:05d}")
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    rows = skewed_rows()
    return rows, spark.createDataFrame(rows, "row int, user_id string, business_id string, review_id string")


@pytest.mark.parametrize("small, row_key", [(10_000, None), (0, None), (0, "row"), (100, "row")])
def test_codes_are_dense_and_in_key_order(skewed, small, row_key):
    rows, df = skewed
    columns = ["user_id", "business_id", "review_id"]
    expected = []
    for position in (1, 2, 3):
        order = {k: i for i, k in enumerate(sorted({r[position] for r in rows if r[position] is not None}))}
        expected.append([order.get(r[position]) for r in rows])
    encoded = encode.encode_ids(df, columns, row_key, small=small)
    assert encoded.columns == df.columns
    got = sorted(tuple(r) for r in encoded.collect())
    assert got == list(zip([r[0] for r in rows], *expected))


def test_codes_do_not_depend_on_partitioning(skewed):
    _, df = skewed
    one = encode.dense_codes(df.repartition(1), ["user_id"]).table
    many = encode.dense_codes(df.repartition(13), ["user_id"]).table
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_codes_of_an_empty_or_all_null_column(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "row int, k string")
    codes = encode.dense_codes(df, ["k"])
    assert codes.sizes == {"k": (0, 0)} and codes.bounds() == {"k": (0.0, 0.0)}
    assert [r["k"] for r in encode.apply_codes(df, codes, ["k"], spread_by=["row"]).collect()] == [None, None]


def test_hot_key_is_spread_over_the_shuffle(spark):
    """In the shuffle route no partition gets the whole hot key or all NULL keys."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k"), "id")
    lookup = df.where("k is not null").groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    joined = lookup_join(df, lookup, ["k"], "n", ["id"], small=0)
    assert joined.where("k is null and v is not null or v <> k * 2 or (k is not null and v is null)").count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(df, lookup, ["k"], "n", ["id"], small=0)
        placed = joined.withColumn("part", F.spark_partition_id())
        sizes = [r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n"), F.max("v")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 30_000 and len(sizes) == 4 and max(sizes) < 12_000


def test_minmax(spark):
    df = spark.createDataFrame([(1.0, 5, 3), (3.0, 5, None), (2.0, 5, 7)], "a double, b int, c int")
    want = [(0.0, 0.0, 0.0), (1.0, 0.0, None), (0.5, 0.0, 1.0)]
    assert [tuple(r) for r in encode.minmax_scale(df, ["a", "b", "c"]).collect()] == want
    bounds = {"a": (1, 3), "b": (5, 5), "c": (3, 7)}
    assert [tuple(r) for r in encode.minmax_scale(df, ["a", "b", "c"], bounds).collect()] == want


def box_by_hand(values):
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [v for v in values if low <= v <= high]
    return (len(values), q1, median, q3, min([*inside, q1]), max([*inside, q3]), len(values) - len(inside))


@pytest.mark.parametrize("small", [10_000, 0])
@pytest.mark.parametrize("shape", ["continuous", "few values", "one hot value"])
def test_box_stats_match_numpy(spark, shape, small):
    pick = random.Random(shape)
    draw = {
        "continuous": lambda: pick.expovariate(0.1), "few values": lambda: float(pick.randrange(4)),
        "one hot value": lambda: 7.0 if pick.random() < 0.8 else pick.gauss(0, 50),
    }[shape]
    rows = [(pick.choice("aaaaab") if i else "single", draw()) for i in range(2_000)]
    extra = [("a", None), (None, 1.0), ("a", float("nan"))]
    df = spark.createDataFrame(rows + extra, "g string, y double").repartition(5)
    got = {r["g"]: tuple(r)[1:] for r in summarize.box_stats(df, ["g"], "y", small=small).collect()}
    assert set(got) == {"a", "b", "single"}
    for group, stats in got.items():
        assert stats == pytest.approx(box_by_hand([y for g, y in rows if g == group]), abs=1e-9)


def test_box_outliers_and_approximate_boxes(spark):
    pick = random.Random(5)
    rows = [(i, pick.choice("xy"), pick.expovariate(0.2)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "i int, g string, y double")
    expected = set()
    for group in "xy":
        values = [y for _, g, y in rows if g == group]
        q1, q3 = np.percentile(values, [25, 75])
        expected |= {i for i, g, y in rows if g == group and not q1 - 1.5 * (q3 - q1) <= y <= q3 + 1.5 * (q3 - q1)}
    for small in (100, 0):
        found = summarize.box_outliers(df, ["g"], "y", spread_by=["i"], small=small)
        assert {r["i"] for r in found.collect()} == expected
    for r in summarize.box_stats(df, ["g"], "y", exact=False).collect():
        exact = box_by_hand([y for _, g, y in rows if g == r["g"]])
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx(exact[1:4], rel=0.02)


def test_crosstab_total_and_missing_dates(spark):
    df = spark.sql("""select * from values (timestamp'2024-01-01 10:00:00', 1), (timestamp'2024-01-01 11:00:00', 5),
                      (timestamp'2024-01-07 00:00:00', 5), (null, 3) as t(date, stars)""")
    days = {r["day"]: tuple(r)[1:] for r in summarize.crosstab_day_stars(df).collect()}
    assert days == {"Monday": (1, 0, 0, 0, 1), "Sunday": (0, 0, 0, 0, 1)}
    months = {r["month"]: tuple(r)[1:] for r in summarize.crosstab_month_stars(df).collect()}
    assert months == {"January": (1, 0, 0, 0, 2)}


def test_distinct_counts(skewed):
    rows, df = skewed
    exact = summarize.distinct_keys(df).first()
    assert tuple(exact) == tuple(len({r[i] for r in rows} - {None}) for i in (1, 2, 3))
    near = summarize.distinct_keys(df, exact=False).first()
    assert tuple(near) == pytest.approx(tuple(exact), rel=0.2)
    assert summarize.distinct_values(df, "business_id").count() == 40


@pytest.mark.parametrize("n", [0, 1, 2, 999, 3_000, 5_000])
def test_first_rows(skewed, n):
    rows, df = skewed
    got = slices.first_rows(df.repartition(7), n, "review_id").collect()
    assert sorted(r["review_id"] for r in got) == sorted(r[3] for r in rows)[:n]


def test_peek(skewed):
    _, df = skewed
    assert [r["row"] for r in slices.peek(df, 3, "row").collect()] == [0, 1, 2]


def test_first_rows_never_take_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    for n in (2, 3, 9):
        assert sorted(r["k"] for r in slices.first_rows(df, n, "k").collect()) == ["a", "b"]


def test_nan_is_no_outlier(spark):
    rows = [("g", float(v)) for v in range(20)] + [("g", 500.0), ("g", float("nan")), ("g", None)]
    df = spark.createDataFrame(rows, "g string, y double").withColumn("i", F.monotonically_increasing_id())
    assert [r["y"] for r in summarize.box_outliers(df, ["g"], "y", spread_by=["i"]).collect()] == [500.0]



def test_splits_are_disjoint_complete_and_stable(skewed):
    _, df = skewed
    def train_rows(d):
        return {r["row"] for r in slices.hash_split(d, "row").where("split = 'train'").collect()}
    assert train_rows(df) == train_rows(df.repartition(11))
    labelled = df.withColumn("label", F.lit(1.0))
    train, test = slices.train_test(labelled, "row")
    assert "trueLabel" in test.columns and train.count() + test.count() == df.count()
    assert 0.65 < train.count() / df.count() < 0.75
    parts = [sorted(r["row"] for r in p.collect()) for p in slices.random_split(df, "row", [0.7, 0.3], seed=3)]
    again = [sorted(r["row"] for r in p.collect()) for p in slices.random_split(df.repartition(9), "row", [0.7, 0.3], 3)]
    assert sorted(parts[0] + parts[1]) == list(range(3_000)) and parts == again


TEXTS = [
    (1, "The food wasn't good. I can't say it's great!"), (1, "Good food, GOOD service; cannot complain..."),
    (2, "the dogs' bone (cold)--again"), (5, ""), (5, None), (5, "Great! great? \"Great\" u.s. a.b."), (9, "ignored words"),
]


def test_word_counts_equal_the_token_lists(spark):
    df = spark.createDataFrame(TEXTS, "stars int, text string")
    tokens = df.select("stars", clean_tokens(word_tokens(F.col("text"))).alias("w")).collect()
    expected = Counter((r["stars"], w.lower()) for r in tokens if r["w"] and r["stars"] != 9 for w in r["w"])
    got = {(r["stars"], r["word"]): r["n"] for r in words.word_freq_by_rating(df).collect()}
    assert got == dict(expected)
    assert got[(1, "good")] == 3 and got[(1, "nt")] == 2 and got[(5, "great")] == 3


@pytest.mark.parametrize("limit", ["1000", "2"])
def test_top_k_with_ties_on_both_routes(spark, limit):
    pick = random.Random(7)
    rows = [(pick.choice("aaab"), f"w{i}", pick.randrange(12)) for i in range(600)]
    spark.conf.set(words.GROUP_LIMIT_CONF, limit)
    try:
        top = words.top_k_per_group(spark.createDataFrame(rows, "g string, word string, n int"), "g", "n", "word", 5)
        got = {g: [(r["word"], r["rank"]) for r in sorted(top.collect(), key=lambda r: r["rank"]) if r["g"] == g]
               for g in "ab"}
    finally:
        spark.conf.unset(words.GROUP_LIMIT_CONF)
    for g in "ab":
        best = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:5]
        assert got[g] == [(r[1], i + 1) for i, r in enumerate(best)]
