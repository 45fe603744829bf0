"""Every registered query against DuckDB."""

import pytest
from oracle import connect, differences
from pyspark.ml.feature import StopWordsRemover

from __spark_entry__ import entry, oracle_sql, queries
from reviewscope.plans.registry import QUERIES
from reviewscope.plans.sql import ML_STOP_WORDS


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, tables, name):
    assert differences(queries()[name](spark, sf_dir), tables, oracle_sql()[name]) is None


def test_every_own_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_gives_top_words(spark):
    rows = entry(spark).collect()
    assert {r["stars"] for r in rows} == {1, 2, 3, 4, 5}
    assert max(r["rank"] for r in rows) == 25


def test_model_stop_words_are_the_defaults(spark):
    assert ML_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_texts_are_not_shuffled_by_review(spark, sf_dir, capsys):
    queries()["join_predictions_source"](spark, sf_dir).explain("extended")
    plan = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1]
    assert plan.index("Join Inner, (review_id") < plan.index("md5(")
