"""The pipeline on planted rows, and on an empty table with foreign columns."""

from pyspark.sql import functions as F

import corpus_pipeline as cp
from reviewscope.llm.common import read_table
from reviewscope.session import materialize


def test_stages_take_effect(spark, sf_dir, docs_of, sentence):
    item = read_table(spark, sf_dir, "benchmark").orderBy("item_id").first()["text"]
    base = read_table(spark, sf_dir, "documents").where("length(text) > 400 and lang = 'en'").limit(12).collect()
    texts = [r["text"] for r in base]
    rows = [(1000 + i, t, "en", "a", 1, "k", 0.5) for i, t in enumerate(texts)]
    rows += [(2000, texts[0], "en", "b", 1, "k", 0.5), (2001, texts[1] + " end", "en", "b", 1, "k", 0.5), (1000, texts[0], "en", "a", 1, "k", 0.5)]
    rows += [(3000, texts[2][:200] + " " + item + " " + texts[3][:300], "en", "b", 1, "k", 0.5)]
    rows += [(4000, "漢字かな交じり文の長い文章です。" * 9, None, "b", 1, "k", 0.5), (4001, None, None, None, None, "k", 0.5)]
    docs = docs_of(rows, ", copies string, score double")
    seen = []
    for name, stage in cp.STAGES:
        out = materialize(stage(spark, docs, sf_dir), name)
        if name != "sharding":
            assert out.columns == docs.columns
        ids = [r["doc_id"] for r in out.collect()]
        docs = out
        seen.append(ids)
    language, near, leaks, mixed, shards = seen
    assert 4000 not in language and 4001 not in language and 3000 in language
    assert {2000, 2001}.isdisjoint(near) and near.count(1000) == 1 and 1001 in near
    assert 3000 in near and 3000 not in leaks
    assert set(mixed) <= set(leaks) and max(mixed.count(x) for x in mixed) <= 2
    assert sorted(shards) == sorted(mixed)


def test_empty_table(spark, sf_dir, docs_of):
    docs = docs_of([], ", row int")
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0


def test_run_keeps_clean_documents(spark, sf_dir):
    out = cp.run(spark, sf_dir).select("doc_id").distinct()
    labels = read_table(spark, sf_dir, "labels").where("quality = 1")
    kept = labels.join(out, "doc_id").count() / labels.count()
    assert kept > 0.5 and out.where(F.col("doc_id").isNull()).isEmpty()


def test_rows_without_id_leave_one_of_each_group(spark, sf_dir, docs_of, sentence):
    a, b, c = sentence(80, "a"), sentence(80, "b"), sentence(80, "c")
    rows = [(None, a), (None, a + " more"), (None, a), (None, b), (7, b), (8, c), (8, c), (8, a[:150] + " other")]
    docs = docs_of([(k, t, "en", "s", 0) for k, t in rows])
    out = [(r["doc_id"], r["text"]) for r in cp.remove_near_duplicates(spark, docs, sf_dir).collect()]
    without = [t for k, t in out if k is None]
    assert len(without) == 1 and without[0] in (a, a + " more")
    assert out.count((7, b)) == 1 and sum(k == 8 for k, _ in out) >= 1 and out.count((8, c)) <= 1
