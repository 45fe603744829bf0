"""Ranked documents against a plain scoring of all of them; best positions against last-read positions."""

import math
import random
import re
from collections import Counter

import numpy as np

from reviewscope.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(ls.UPPER, ls.LOWER)


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(docs, items, k=10):
    held = [(key, Counter(terms_of(t))) for key, t in docs if terms_of(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for key, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms if t in c
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if null else key, -s) for i, (s, null, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    d = spark.createDataFrame([(k_, t, "x", 1) for k_, t in docs], "doc_id bigint, text string, rank string, n int")
    q = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id bigint, text string, score int")
    return sorted(map(tuple, ls.rank_documents(d, q, k).collect()), key=str)


def words(rng, n):
    return " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(n))


def test_equals_plain_scoring(spark, monkeypatch):
    rng = random.Random(4)
    docs = [(i, words(rng, rng.randrange(0, 90))) for i in range(400)]
    docs += [(900 + i, docs[7][1]) for i in range(30)]  # ties, longer than k
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, ""), (5000, None), (5001, " ,.! "), (5002, "ÄÖ Straße ÀB w1"), (5003, "w1 " * 60_000)]
    items = [(i, words(rng, 12)) for i in range(12)] + [(50, docs[7][1]), (51, ""), (52, None), (53, "nowhere"), (54, "straße ÄÖ W1"), (None, "w2 w3"), (3, "w250")]
    want = expected(docs, items)
    assert found(spark, docs, items) == want
    monkeypatch.setattr(ls, "BLOCK_TERMS", 40)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, 3) == expected(docs, items, 3)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def _shard(rng, n_docs, n_terms):
    rows = [np.sort(rng.choice(n_terms, rng.integers(0, n_terms), replace=False)) for _ in range(n_docs)]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    ids = np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64)
    return ls.Shard(starts, ids, rng.integers(0, 40, len(ids)) ** 3, n_terms)


def last_read_depth(shard, terms, k):
    """Depth at which the plain threshold (impacts at the last positions read) ends the search."""
    terms = [t for t in terms if shard.list_starts[t + 1] > shard.list_starts[t]]
    score = np.zeros(len(shard.starts) - 1, np.int64)
    for t in terms:
        part = slice(shard.list_starts[t], shard.list_starts[t + 1])
        np.add.at(score, shard.list_docs[part], shard.list_impacts[part])
    met, depth, step = set(), 0, ls.FIRST_READ
    while True:
        depth, step, limit = depth + step, 2 * step, 0
        for t in terms:
            a, b = shard.list_starts[t], shard.list_starts[t + 1]
            met |= set(shard.list_docs[a:min(a + depth, b)].tolist())
            limit += int(shard.list_impacts[a + depth - 1]) if a + depth < b else 0
        top = sorted((int(score[d]) for d in met), reverse=True)
        if limit == 0 or (len(top) >= k and limit < top[k - 1]):
            return depth, score


def test_best_positions_stop_no_later_and_keep_ties():
    rng = np.random.default_rng(6)
    earlier = 0
    for _ in range(60):
        shard = _shard(rng, int(rng.integers(1, 400)), int(rng.integers(1, 9)))
        terms = np.arange(len(shard.list_starts) - 1)
        k = int(rng.integers(1, 12))
        docs, scores = shard.best(terms, k)
        depth, score = last_read_depth(shard, terms, k)
        sizes = np.diff(shard.list_starts)
        assert shard.reads <= np.minimum(sizes, depth).sum()
        earlier += shard.reads < np.minimum(sizes, depth).sum()
        order = np.sort(score[score > 0])[::-1]
        kth = order[k - 1] if len(order) >= k else 1
        want = {(d, s) for d, s in enumerate(score.tolist()) if s >= kth}
        assert {(d, s) for d, s in zip(docs.tolist(), scores.tolist()) if s >= kth} == want
    assert earlier > 0
