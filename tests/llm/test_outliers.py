"""Statistics against a direct count, the estimate against numpy, verdicts on planted junk."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewscope.llm import outliers as ou

GAP = re.compile(r"[^\x20\x09-\x0D]+")


def direct(text):
    text = text or ""
    words = GAP.findall(text)
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if GAP.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in ou.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def test_statistics(docs_of, sentence):
    texts = [
        None, "", " \t\r\n ", "one", "a b", "a b c a b c", "a a a a", "x y z\nx y z\n\n \nx y z ", "é#ü*$%&|<>é", "a b c d a b c x\x0bb c x",
        "\n".join([sentence(20, 1)] * 3 + [sentence(20, 2)]), "w " * 5000, "   ",
    ]
    for r in ou.text_statistics(docs_of(texts)).collect():
        want = direct(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_junk_goes_and_clean_texts_stay(docs_of, sentence):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        text = sentence(rng.choice([60, 100, 300, 900]), i)
        if i % 20 == 0:
            text = " ".join(w + rng.choice(["###", "***"]) for w in text.split())
        rows.append((i, text, ["en", None][i % 2], ["a", "b"][i % 3 == 0], 0))
    out = ou.judge_quality(docs_of([r[:5] for r in rows])).collect()
    assert len(out) == 400
    for r in out:
        assert r["kept"] == (r["doc_id"] % 20 != 0), (r["doc_id"], r["d2"])


def test_odd_rows(docs_of, sentence):
    long = sentence(80, 1)
    rows = [(None, long, None, None, 0), (1, long, "en", "s", 0), (1, long, "en", "s", 0), (2, None, "en", "s", 0), (3, "few", "xx", "yy", 0)]
    out = ou.judge_quality(docs_of(rows)).collect()
    assert sorted(r["kept"] for r in out) == [False, False, True, True, True]
    assert ou.judge_quality(docs_of([])).collect() == []


def test_estimate_ignores_outliers(spark):
    rng = np.random.default_rng(1)
    mixed = rng.normal(size=(800, ou.DIM)) @ np.diag([2, 1, 1.5, 1, 3.0]) + 5
    mixed[:150] += 60
    rows = [("1en", "1s", *map(float, np.round(x, 4))) for x in mixed]
    df = spark.createDataFrame(rows, ", ".join(["g_lang string", "g_source string", *[f"{x} double" for x in ou.X]])).cache()
    est = ou.fit_mcd(df).first()
    clean = mixed[150:]
    assert np.allclose([est[f"m{i}"] for i in range(ou.DIM)], clean.mean(0), atol=0.35)
    far = ou._with_distance(df, ou.fit_mcd(df)).select("x0", "d2").collect()
    assert min(r["d2"] for r in far if r["x0"] > 40) > ou.CUTOFF
    assert np.mean([r["d2"] > ou.CUTOFF for r in far if r["x0"] < 40]) == 0


def test_quantiles():
    assert ou.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert ou.chi2_quantile(0.5, 2) == pytest.approx(1.3863, abs=1e-3)
    assert 1.2 < ou.CONSISTENCY < 1.6


def test_no_python_in_the_plans(docs_of):
    plan = ou.text_statistics(docs_of(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_of_any_name_pass_through(docs_of, sentence):
    rows = [(i, sentence(60 + i, i), "en", "s", 0, *[f"v{i}"] * 7) for i in range(12)]
    names = ["kept", "middle", "_salt", "_words", "n_words", "x0", "whole_row"]
    docs = docs_of(rows, "".join(f", {n} string" for n in names))
    out = ou.judge_quality(docs).collect()
    assert len(out) == 12 and all(type(r["kept"]) is bool and r["n_words"] == 60 + r["doc_id"] for r in out)
    assert all(r[n] == f"v{r['doc_id']}" for r in out for n in ("middle", "_salt", "_words", "x0", "whole_row"))
