"""Sentences whose abbreviations are found from the texts."""

import random

import pytest
from pyspark.sql import functions as F

from reviewscope.operators import sentences as st

SCHEMA = "id int, text string, tokens string, place int"


def _corpus():
    rng = random.Random(5)
    plain = "the clean room was really nice and quiet but dinner took ages to come so people left early".split()
    names, rows = ["Smith", "Jones", "Brown", "Miller"], []
    for _ in range(300):
        words = [rng.choice(plain) for _ in range(rng.randint(4, 9))]
        kind = rng.randrange(5)
        if kind == 0:
            words[1:1] = ["Dr.", rng.choice(names)]
        elif kind == 1:
            words[2:2] = ["e.g.,", "tea"]
        elif kind == 2:
            words[2:2] = ["at", "5", "p.m.", "and"]
        rows.append(" ".join([words[0].capitalize(), *words[1:]]) + rng.choice([".", ".", ".", "!", "?"]))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    lines = _corpus()
    df = spark.createDataFrame([(i, " ".join(lines[i:i + 6]), "z", 1) for i in range(0, 300, 6)], SCHEMA)
    return st.sentence_model(df)


def _sentences(spark, model, *texts):
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], SCHEMA)
    rows = st.sentences(df, "id", "text", model).orderBy("id", "sentence").collect()
    return [[" ".join(r["tokens"]) for r in rows if r["id"] == i] for i in range(len(texts))]


def test_abbreviations_are_found(model):
    assert {r["word"] for r in model.abbreviations.collect()} == {"dr", "e.g", "p.m"}


def test_abbreviations_keep_their_period(spark, model):
    assert _sentences(spark, model, "We met Dr. Brown, e.g. at 5 p.m. in town. It's nice.") == [
        ["We met Dr. Brown , e.g. at 5 p.m. in town .", "It 's nice ."]]


def test_a_starter_ends_the_sentence_after_an_abbreviation(spark, model):
    assert _sentences(spark, model, "Dinner came at 5 p.m. The room (No. 7) was nice.", "Ask Dr. Smith") == [
        ["Dinner came at 5 p.m .", "The room ( No .", "7 ) was nice ."], ["Ask Dr. Smith"]]


def test_marks_quotes_and_several_periods(spark, model):
    assert _sentences(spark, model, 'He said "no." Then left... quietly... Good!? Yes 3.5 ok', "Don't. Can't (really.)") == [
        ['He said " no . "', "Then left ... quietly ...", "Good ! ?", "Yes 3.5 ok"], ["Do n't .", "Ca n't ( really . )"]]


def test_empty_and_null(spark, model):
    assert _sentences(spark, model, None, "", " \n ", ".", "...") == [[], [], [], ["."], ["..."]]
    none = st.sentence_model(spark.createDataFrame([], SCHEMA))
    assert none.abbreviations.count() == none.starters.count() == 0
    assert _sentences(spark, none, "One. two") == [["One .", "two"]]


def test_scores_follow_the_formula(spark):
    import math

    df = spark.createDataFrame([(0, "a.b. a.b. x. x y y y y z q", "", 0)], SCHEMA)
    got = {r["word"]: r for r in st.abbreviation_scores(st.piece_uses(df)).collect()}
    share = 3 / 10
    ratio = 2 * (math.log(.99 / share) + math.log(.01 / (1 - share)))
    assert set(got) == {"a.b", "x"}
    assert got["x"]["ratio"] == pytest.approx(ratio) and got["x"]["score"] == pytest.approx(ratio * math.exp(-1))
    assert got["a.b"]["score"] == pytest.approx(4 * math.log(.99 / share) * math.exp(-2) * 2)


def test_very_long_text_and_many_periods(spark, model):
    text = "Dr. Smith " * 60_000 + "." * 200_000 + "a"
    rows = st.sentences(spark.createDataFrame([(0, text, "", 0)], SCHEMA), "id", "text", model).agg(
        F.count("*").alias("n"), F.sum(F.size("tokens")).alias("tokens")).first()
    assert rows["n"] == 1 and rows["tokens"] > 120_000


def test_few_rows_per_distinct_piece(spark):
    df = spark.createDataFrame([(i, "so it is. It was so good", "", 0) for i in range(50)], SCHEMA)
    assert st.piece_uses(df).count() == 7
