"""Kneser-Ney probabilities, held-out accuracy, rejection, edge rows."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest

from reviewscope.llm import language_id as li
from reviewscope.llm.common import read_table, text_parts


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    return li.fit_languages(read_table(spark, sf_dir, "documents").where(~li.held_out("doc_id")))


def test_held_out_accuracy(spark, sf_dir, models):
    rows = li.identify(read_table(spark, sf_dir, "documents"), models).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert sum(r["rejected"] for r in rows) <= 0.005 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_and_ids_are_not_inputs(docs_of, models):
    rows = [(1, "the thing and the other", "fr", "a", 0), (2, "the thing and the other", None, None, None)]
    a, b = li.identify(docs_of(rows), models).collect()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_no_letters_null_and_foreign_scripts(docs_of, models):
    texts = [None, "", "12 34 !?", "漢字かな交じり文のとても長い文章です。" * 5, "x" * 200_000, "the and of"]
    out = {r["doc_id"]: r for r in li.identify(docs_of([(i, t, None, None, 0, 1.0) for i, t in enumerate(texts)], ", score double"), models).collect()}
    for i in range(3):
        assert out[i]["lang_pred"] == "und" and out[i]["score"] == 0 and out[i]["rejected"]
    assert out[3]["rejected"] and not out[5]["rejected"] and out[4]["n_letters"] == 200_000


def test_nothing_learned(docs_of):
    docs = docs_of([(1, "abc", None, None, 0)])
    empty = li.fit_languages(docs)
    r = li.identify(docs, empty).first()
    assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
    assert li.identify(docs.limit(0), empty).collect() == []
    assert li.fit_languages(docs_of([(1, None, "en", None, 0)])).languages == []


def test_probabilities_sum_to_one_and_match_the_tables():
    counts = {"aaab": 3, "aabc": 1, "abca": 2, "bcaa": 2, " aab": 1, "caab": 1}
    model = li.KneserNey(counts)
    seen = sorted({c for g in counts for c in g})
    for context in ("aaa", "aab", "zzz", "ab", ""):
        mass = sum(model.probability(context + c) for c in seen)
        rest = 1.0
        for i in range(len(context) + 1):
            rest *= model.backoff(context[i:])
        assert mass + rest * (li.ALPHABET - len(seen)) / li.ALPHABET == pytest.approx(1.0)
    tables = li.LanguageModels.fit({"x": counts, "y": {"abcd": 5}})
    codes, starts = next(text_parts(pa.array(["aab caa zb"]), 1 << 20))
    padded, places, _ = li.letter_stream(codes, starts)
    got = tables.log_probabilities(padded, places)
    text = "".join(map(chr, padded))
    want = [math.log(model.probability(text[p - 3:p + 1])) for p in places]
    assert np.allclose(got[:, 0], want, atol=1e-4)


def test_streams_are_cut_at_texts():
    texts = ["A  b!", None, "  ", "Éx", ""]
    whole = [np.concatenate([c for c, _ in text_parts(pa.array(texts), n)]) for n in (1, 1 << 20)]
    assert np.array_equal(*whole)
    codes, starts = next(text_parts(pa.array(texts), 1 << 20))
    padded, places, lengths = li.letter_stream(codes, starts)
    assert lengths.tolist() == [4, 0, 0, 2, 0] and "".join(map(chr, padded[places])) == "a b éx"


def test_every_labelled_text_is_learned_from_and_calibrates(docs_of, monkeypatch):
    seen = []
    calibrate = li._calibrate
    monkeypatch.setattr(li, "_calibrate", lambda models, scored: (seen.append(scored.count()), calibrate(models, scored)))
    # 999 texts of one language, each with a word of its own: 900 of them were outside a sample of 300 and more.
    rows = [(i, f"the common words {''.join(chr(97 + int(d)) for d in f'{i:03}')}qz", "en", None, 0) for i in range(999)]
    models = li.fit_languages(docs_of([*rows, (2000, "les mots communs", "fr", None, 0)]))
    known = set(models.grams[li.ORDER][0].tolist())
    chars = np.array([[ord(c) for c in text[-5:-1]] for _, text, *_ in rows], np.uint32)
    assert set(li._row_hashes(chars).tolist()) <= known
    assert models.languages == ["en", "fr"] and seen == [999] and models.means is not None


def test_a_filter_on_the_result_scores_texts_once(docs_of, models):
    rows = docs_of([(i, f"the common words of text {i}", "en", None, 0) for i in range(4)] + [(9, None, "en", None, 0)])
    scored = li._entropies(rows, models)
    assert scored.count() == 4 and scored._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
