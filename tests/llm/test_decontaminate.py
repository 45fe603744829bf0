"""All placements of substitutions, and random texts against laying every item everywhere; blocks of the benchmark; edge rows."""

from itertools import combinations

import numpy as np
import pytest

from reviewscope.llm import decontaminate as dc
from reviewscope.llm.common import read_table


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def flagged(docs, items, **names):
    return {r["doc_id"]: r["leaked_items"] for r in dc.find_leaks(docs, items, **names).collect()}


def swapped(text, every):
    return " ".join(f"other{i}" if i % every == every - 1 else w for i, w in enumerate(text.split()))


def test_leaks_survive_substitutions(spark, docs_of, sentence):
    passages = [sentence(40, f"b{i}") for i in range(6)]
    items = items_of(spark, [(10 + i, p) for i, p in enumerate(passages)] + [(99, passages[0]), (50, None), (51, " -- ")])
    clean = [sentence(300, f"c{i}") for i in range(20)]
    docs = [
        f"{clean[0]} {passages[0]} {clean[1]}", f"{clean[2]} {passages[1].upper()}", f"{swapped(passages[2], 8)} {clean[3]}",
        passages[3].replace(" ", ", "), f"{clean[4]} {swapped(passages[4], 2)}", f"{passages[5]} x {passages[1]}",
        *clean, "", None, "the of",
    ]
    got = flagged(docs_of(docs), items)
    assert got[0] == [10, 99] and got[1] == [11] and got[2] == [12] and got[3] == [13]
    assert got[4] == [] and got[5] == [11, 15]
    assert all(got[i] == [] for i in range(6, len(docs)))


def test_short_items_match_as_a_whole(spark, docs_of):
    items = items_of(spark, [(1, "alpha beta gamma delta epsilon zeta"), (2, "one two three")])
    got = flagged(docs_of(["x alpha beta gamma delta epsilon zeta y", "alpha beta gamma delta epsilon", "one two three"]), items)
    assert got == {0: [1], 1: [], 2: [2]}


def test_blocks_change_nothing(spark, sf_dir, monkeypatch):
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    whole = flagged(docs, items)
    monkeypatch.setattr(dc, "BLOCK_TOKENS", 300)
    assert len(list(dc._blocks(items, "item_id", "text"))) > 3
    assert flagged(docs, items) == whole and any(whole.values())


def test_empty_tables_repeats_and_names(spark, docs_of):
    items = items_of(spark, [(None, "a b c d e f g"), (3, "a b c d e f g")])
    rows = [(1, "a b c d e f g", None, None, 0, "x"), (1, "a b c d e f g", None, None, 0, "y"), (None, None, None, None, 0, "z")]
    out = dc.find_leaks(docs_of(rows, ", item_id string"), items).collect()
    assert sorted(len(r["leaked_items"]) for r in out) == [0, 2, 2] and {r["item_id"] for r in out} == {"x", "y", "z"}
    assert dc.find_leaks(docs_of([]), items).collect() == []
    assert flagged(docs_of(["a b c d e f g"]), items.limit(0)) == {0: []}


def test_masked_tokens_do_not_count():
    for window in range(1, dc.WINDOW + 1):
        tokens = np.arange(window, dtype=np.uint64)
        for mask in dc.masks(window):
            assert len(mask) == window and "1" in mask
            other = np.where(np.array(list(mask)) == "1", tokens, tokens + np.uint64(99))
            assert dc.seed_hashes(tokens, mask) == dc.seed_hashes(other, mask)
            assert dc.seed_hashes(tokens, mask) != dc.seed_hashes(tokens + np.uint64(1), mask)


def expected(item, doc):
    """Most equal tokens over all ways to lay the item's windows on the document."""
    window = min(dc.WINDOW, len(item))
    counts = [sum(a == b for a, b in zip(item[i:i + window], doc[j:j + window]))
              for i in range(len(item) - window + 1) for j in range(len(doc) - window + 1)] if window else []
    most = max(counts, default=0)
    return most if most and most >= dc.AGREE * window - 1e-9 else 0


@pytest.mark.parametrize("size", range(1, 21))
def test_every_placement_of_substitutions_is_found(size):
    item = np.arange(1, size + 1, dtype=np.uint64)
    table = dc.SeedTable([(7, item)])
    window = min(dc.WINDOW, size)
    for start in range(size - window + 1):
        for places in combinations(range(window), window - dc.least_agreement(window)):
            doc = np.arange(1000, 1000 + size + 9, dtype=np.uint64)
            doc[4:4 + window] = item[start:start + window]
            doc[[4 + p for p in places]] += np.uint64(5000)
            assert dc.leaks(doc, np.array([0, len(doc)]), table) == {0: {0: dc.least_agreement(window)}}


def test_equals_laying_everything_everywhere(monkeypatch):
    rng = np.random.default_rng(9)
    monkeypatch.setattr(dc, "VERIFIED_TOKENS", 50)
    total = 0
    for _ in range(12):
        items = [rng.integers(0, 5, int(rng.integers(0, 22))).astype(np.uint64) for _ in range(6)]
        docs = [rng.integers(0, 6, int(rng.integers(0, 60))).astype(np.uint64) for _ in range(8)]
        starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        want = {}
        for d, doc in enumerate(docs):
            for k, item in enumerate(items):
                most = expected(item.tolist(), doc.tolist())
                if most:
                    want.setdefault(d, {})[k] = most
        assert dc.leaks(np.concatenate(docs), starts, dc.SeedTable(list(enumerate(items)))) == want
        total += sum(map(len, want.values()))
    assert total > 20
