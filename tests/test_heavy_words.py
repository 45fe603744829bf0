"""Top words from counters and candidates, against counting everything."""

import random

import pytest

from reviewscope.operators import heavy_words as hw
from reviewscope.operators.words import top_words_by_rating

SCHEMA = "stars int, text string, word string, n int"


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(3)
    common = [f"w{i}" for i in range(60)]
    rows = [(rng.choice([1, 2, 5]), " ".join([*rng.choices(common, range(60, 0, -1), k=30), *(f"x{rng.randrange(4000)}." for _ in range(20))]), "z", 1)
            for _ in range(300)]
    rows += [(4, "only The three words, words", "z", 1), (3, None, "z", 1), (3, "", "z", 1), (9, "unrated", "z", 1), (None, "unrated", "z", 1)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def _rows(df):
    return sorted(tuple(r) for r in df.select("stars", "word", "n", "rank").collect())


@pytest.mark.parametrize("counters", [1, 8, 256, hw.COUNTERS])
def test_equals_full_count(texts, counters):
    assert _rows(hw.heavy_words_by_rating(texts, 25, counters=counters)) == _rows(top_words_by_rating(texts, 25))


@pytest.mark.parametrize("k", [1, 70, 5000])
def test_any_number_of_words(texts, k):
    assert _rows(hw.heavy_words_by_rating(texts, k, counters=64)) == _rows(top_words_by_rating(texts, k))


def test_ties_at_the_last_place_go_by_the_word(spark):
    df = spark.createDataFrame([(1, " ".join(f"t{i:03}" for i in range(200)), "", 0)] * 3, SCHEMA)
    assert _rows(hw.heavy_words_by_rating(df, 3, counters=16)) == [(1, f"t{i:03}", 3, i + 1) for i in range(3)]


def test_few_words_are_counted_and_counters_stay_bounded(texts):
    words = texts.select("stars", hw.F.explode(hw.words_of(hw.F.col("text"))).alias("word"))
    table = hw.counter_table(words, "stars", 3, 256)
    assert table.count() <= 5 * 3 * 256
    floors = hw._nth_largest(table.where("row = 0"), "stars", 40)
    counted = hw._counted(words, "stars", floors, table, 3, 256).count()
    assert counted * 4 < words.distinct().count()


def test_empty_table(spark):
    assert hw.heavy_words_by_rating(spark.createDataFrame([], SCHEMA)).collect() == []


def test_equal_words_are_counted_where_they_are_read(spark, monkeypatch):
    rows = [(1 + i % 2, "same words, same  words\tagain don't", "", 0) for i in range(2000)]
    df = spark.createDataFrame([*rows, (3, "x" * 50, "", 0), (4, None, "", 0)], SCHEMA).coalesce(2)
    words = hw.counted_words(df, "text", "stars", [])
    assert words.count() < 100
    got = {tuple(r) for r in words.groupBy("stars", "word").agg(hw.F.sum("n")).collect()}
    assert {(1, "same", 2000), (2, "words", 2000), (1, "again", 1000), (3, "x" * 50, 1)} <= got
    monkeypatch.setattr(hw, "BATCH_BYTES", 1)
    assert _rows(hw.heavy_words_by_rating(df, 5)) == _rows(top_words_by_rating(df, 5))


def test_plain_words_need_no_rules(spark, monkeypatch):
    """Only pieces that the rules could change go through them; equal ones of many runs are sent on once."""
    monkeypatch.setattr(hw, "BATCH_BYTES", 4_000)
    line = "Great food. The\nÉtoile's é Étoile, 'cannot' Cannot! the*** wow!! 10:30 a.b 1,000 it's café écannot x\x85 end.\nlast\u2028word the, $5"
    df = spark.createDataFrame([(1 + i % 5, line, "", 0) for i in range(3_000)], SCHEMA).coalesce(2)
    assert _rows(hw.heavy_words_by_rating(df, 40)) == _rows(top_words_by_rating(df, 40))
    df = df.withColumn("text", hw.F.translate("text", "\x85", ""))
    assert _rows(hw.heavy_words_by_rating(df, 40)) == _rows(top_words_by_rating(df, 40))
    assert hw.counted_words(df, "text", "stars", []).count() <= 2 * 5 * 45
    held = list(hw._count_pieces([])(iter(df.select("stars", "text").toArrow().to_batches())))
    pieces = hw.pa.Table.from_batches(held)
    rules = {p for p, done in zip(pieces["piece"].to_pylist(), pieces["done"].to_pylist()) if not done}
    assert rules == {"Étoile's", "'cannot'", "Cannot!", "the***", "10:30", "a.b", "1,000", "it's", "écannot", "last\u2028word", "$5"}


def test_counters_are_added_up_in_arrays(spark):
    words = spark.createDataFrame([(1, "a", 5), (1, "b", 2), (None, "a", 1), (9, "a", 3)] * 7, "stars int, word string, n bigint").repartition(3)
    got = {(r["stars"], r["row"]): r["n"] for r in hw.counter_table(words, "stars", 2, 1).collect()}
    assert got == {(s, r): n for s, n in ((1, 49), (None, 7), (9, 21)) for r in (0, 1)}
