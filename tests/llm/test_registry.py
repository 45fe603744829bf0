"""The numbered queries against DuckDB where SQL exists; all are registered."""

import re

import pytest
from oracle import connect, differences

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from reviewscope.llm.queries import LLM_QUERIES, LLM_SQL


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_matches_sql(spark, sf_dir, name):
    assert differences(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name]) is None


def test_every_number_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in LLM_QUERIES)
    assert numbers == list(range(1, 14))
    assert queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontamination", "source_mixing", "sharding",
    ]
