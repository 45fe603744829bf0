import datetime as dt

import pytest
from pyspark.sql import functions as F

from reviewscope.functions import (
    bigrams, binarize, clean_reviews, clean_tokens, is_number, month_name, remove_stop_words, round_abs,
    strip_byte_prefix, strip_punctuation, strip_quotes, weekday_name, word_tokens,
)
from reviewscope.functions.calendar import parse_date
from reviewscope.functions.numbers import round_clip
from reviewscope.functions.wordlists import ENGLISH_STOP_WORDS


def apply(spark, kind, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


@pytest.mark.parametrize("raw, clean", [
    ("b'x'", "x"), ('b"it\'s"', "it's"), ("b'\"x\"'", "x"), ("bare", "bare"), ("", ""), (None, None),
    ("b'stripe'", "stripe"), ("b''", ""), ("bx", "bx"), ("'\"x\"'", "x"), ("\"'x'\"", "'x'"),
])
def test_cell_cleaning(spark, raw, clean):
    assert apply(spark, "string", [raw], lambda v: strip_quotes(strip_byte_prefix(v))) == [clean]


def test_clean_reviews_types_every_column(spark):
    raw = spark.createDataFrame(
        [("b'u1'", "b\"it's, \n fine\"", "b'2018-07-07 22:09:11'", "b'5'", "b'4.0'"),
         ("u2", "plain", "b'bad'", "b'many'", "3")],
        "user_id string, text string, date string, stars string, funny string")
    first, second = clean_reviews(raw).orderBy("user_id").collect()
    assert tuple(first) == ("u1", "it's, \n fine", dt.datetime(2018, 7, 7, 22, 9, 11), 5, 4)
    assert tuple(second) == ("u2", "plain", None, None, 3)


def test_labels_and_rounding(spark):
    assert apply(spark, "int", [1, 2, 3, 5, None], binarize) == [0.0, 0.0, 1.0, 1.0, None]
    scores = [float("nan"), None, -0.6, -0.2, 0.5, 1.5, 2.5]
    assert apply(spark, "double", scores, is_number) == [False, False] + [True] * 5
    assert apply(spark, "double", scores[2:], round_abs) == [1.0, 0.0, 1.0, 2.0, 3.0]
    assert apply(spark, "double", scores[2:], round_clip) == [0.0, 0.0, 1.0, 1.0, 1.0]


def test_calendar(spark):
    dates = ["2018-07-07 22:09:11", "bad", None, "2024-02-29 00:00:00", "2023-12-31 23:59:59"]
    assert apply(spark, "string", dates, lambda v: weekday_name(parse_date(v))) == [
        "Saturday", None, None, "Thursday", "Sunday"]
    assert apply(spark, "string", dates, lambda v: month_name(parse_date(v))) == [
        "July", None, None, "February", "December"]


@pytest.mark.parametrize("text, tokens", [
    ("", []), ("   ", []), ("word", ["word"]), ("...", ["..."]), ("....", ["...", "."]), ("?!", ["?", "!"]),
    ("I can't, it's 1,000.", ["I", "ca", "n't", ",", "it", "'s", "1,000", "."]),
    ("a  b\n\tc d", ["a", "b", "c", "d"]),
    ("at 10:30: (ok)", ["at", "10:30", ":", "(", "ok", ")"]),
    ("We'll go--now", ["We", "'ll", "go", "--", "now"]),
    ("cannot gonna CANNOT scanned", ["can", "not", "gon", "na", "CAN", "NOT", "scanned"]),
    ("the dogs' bone", ["the", "dogs", "'", "bone"]),
    ("v1.2 ends.) x", ["v1.2", "ends", ".", ")", "x"]),
    ("it's... don't.", ["it", "'s", "...", "do", "n't", "."]),
    ('say "hi"', ["say", '"', "hi", '"']),
    ("é_naïve, ça", ["é_naïve", ",", "ça"]),
])
def test_word_tokens(spark, text, tokens):
    assert apply(spark, "string", [text], word_tokens) == [tokens]


def test_very_long_words_do_not_break_the_pattern(spark):
    long = ["x" * 200_000, "n'" * 50_000, "." * 50_001, ("a." * 50_000) + " b"]
    sizes = apply(spark, "string", long, lambda v: F.size(word_tokens(v)))
    assert sizes[0] == 1 and sizes[2] == 16_667 and sizes[3] == 3


def test_stop_words_then_punctuation(spark):
    assert len(ENGLISH_STOP_WORDS) == len(set(ENGLISH_STOP_WORDS)) == 179
    words = ["The", "the.", "Cat", "don't", "!", " ", "n't"]
    assert apply(spark, "array<string>", [words], remove_stop_words) == [["the.", "Cat", "!", " ", "n't"]]
    assert apply(spark, "array<string>", [words], clean_tokens) == [["the", "Cat", "nt"]]
    assert apply(spark, "string", ["a-b, (c)!"], strip_punctuation) == ["ab c"]


def test_bigrams(spark):
    pairs = apply(spark, "array<string>", [[], ["a"], ["a", "b", "c"], None], bigrams)
    assert pairs[:2] == [[], []] and pairs[3] is None
    assert [tuple(p) for p in pairs[2]] == [("a", "b"), ("b", "c")]
