"""Phrase counts and scores against plain counting; filters and packing round trips."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewscope.llm import collocations as co

ENDS = re.compile("[" + re.escape(co.PIECE_ENDS) + "]")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least=co.LEAST, top=co.TOP):
    f = {}
    for lang, text in rows:
        counts = f.setdefault(lang or co.UNKNOWN, Counter())
        for piece in ENDS.split((text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in (1, 2, 3):
                counts.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows_of = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            s, _, left, right = min((10**6 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows_of.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows_of)[:top])]
    return sorted(out)


def found(spark, rows, **settings):
    docs = spark.createDataFrame([(lang, text, 1, "x") for lang, text in rows], "lang string, text string, n int, word string")
    return sorted(map(tuple, co.collocations(docs, **settings).collect()))


@pytest.fixture
def rows():
    rng = random.Random(8)
    seps = [" "] * 12 + [", ", ".", "\n", "\t ", "! ", ";x:", "  "]
    out = []
    for i in range(150):
        text = "".join(f"{rng.choice('aAbBcé')}{int(rng.paretovariate(0.8)) % 40}{rng.choice(seps)}" for _ in range(rng.randrange(120)))
        out.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text))
    return out + [("en", None), ("en", ""), ("xx", " .,;"), ("en", "new york city " * 40), ("en", "nul\x00x y\x00 " * 15), out[0], out[0]]


def test_equals_plain_counting(spark, rows, monkeypatch):
    want = expected(rows)
    assert len({r[0] for r in want}) >= 3 and len(want) > 90
    assert found(spark, rows) == want
    assert found(spark, rows, top=5, least=4) == expected(rows, 4, 5)
    monkeypatch.setattr(co, "RACE_ROWS", 20)
    assert found(spark, rows, top=2) == expected(rows, top=2)
    monkeypatch.setattr(co, "FILTER_ENTRIES", 50)
    monkeypatch.setattr(co, "RANGE_ENTRIES", 500)
    monkeypatch.setattr(co, "CHUNK_BYTES", 300)
    assert found(spark, rows) == want
    monkeypatch.setattr(co, "DICTIONARY_WORDS", 10)  # joined instead of broadcast
    assert found(spark, rows) == want


def test_empty(spark):
    assert found(spark, []) == [] and found(spark, [("en", "")]) == []


@pytest.mark.parametrize("bits", [1, 5, 18, 21, 22, 32])
def test_packing_and_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    n = 3_000
    ids = [rng.integers(0, 1 << bits, n).astype(np.uint64) for _ in range(3)]
    packing = co.Packing(bits)
    q, r = packing.permute(*ids)
    assert q.max() < 1 << bits and r.max() <= packing.wide
    assert all((a == b).all() for a, b in zip(packing.restore(q, r), ids))
    counts = rng.choice([1, 1, 1, 2, 254, 255, 256, 10**12], n)
    entries = packing.in_order(q, r, counts)
    want = Counter()
    for key, c in zip(zip(q.tolist(), r.tolist()), counts.tolist()):
        want[key] += c
    assert dict(zip(zip(entries[0].tolist(), entries[1].tolist()), entries[2].tolist())) == want
    if bits <= 18:
        data = co.write_filter(*entries, 0, 1 << bits, (2 * bits + 7) // 8)
        back = co.read_filter(data, 0, (2 * bits + 7) // 8)
        assert all((a == b).all() for a, b in zip(back, entries))
