"""Removed bytes against a direct reading of the rule; factors and suffix ranks against plain comparison."""

import random

import numpy as np
import pytest

from reviewscope.llm import suffix_dedup as sd


def expected(rows, length, keep):
    """Rows are (id, text); rows of one id share their places."""
    places = {}
    data = [(t or "").encode() for _, t in rows]
    for r, (key, _) in enumerate(rows):
        for i in range(len(data[r]) - length + 1):
            place = (key is None, key if key is not None else r, i)
            places.setdefault(data[r][i:i + length], []).append(place)
    out = []
    for r, (key, _) in enumerate(rows):
        gone = np.zeros(len(data[r]) + 1, bool)
        for i in range(len(data[r]) - length + 1):
            found = places[data[r][i:i + length]]
            place = (key is None, key if key is not None else r, i)
            if (len(found) > 1) if keep == "none" else (min(found) < place):
                gone[i:i + length] = True
        edges = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:-1]).sum())
        kept = bytes(b for b, g in zip(data[r], gone) if not g)
        out.append((key, len(data[r]), int(gone.sum()), edges, kept))
    return sorted(out, key=str)


def found(spark, rows, length, keep, gram):
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id bigint, text string, uid int, kept string")
    got = sd.dedup_bytes(docs, length=length, keep=keep, gram=gram).collect()
    whole = {}
    for k, t in rows:
        whole.setdefault(k, []).append((t or "").encode())
    out = []
    for r in got:
        kept = r["kept"]
        if kept is None:
            import hashlib
            kept = next(d for d in whole[r["doc_id"]] if hashlib.sha256(d).hexdigest() == r["text_sha256"])
        out.append((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(kept)))
    return sorted(out, key=str)


@pytest.fixture
def rows(sentence):
    rng = random.Random(5)
    shared = [sentence(n, f"p{n}") for n in (4, 6, 9, 30)]
    out = []
    for i in range(70):
        parts = [sentence(rng.randrange(0, 25), f"d{i}")]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), sentence(rng.randrange(0, 6), f"e{i}{len(parts)}")]
        out.append((rng.randrange(-50, 200), "é".join(parts)))
    out += [(300 + i, out[3][1]) for i in range(4)] + [(400, "ab" * 200), (401, "a" * 150), (402, "xyz" + "ab" * 40)]
    return out + [(500, None), (501, ""), (502, "short"), (503, "short"), (7, out[5][1]), (7, out[5][1]), (600, sentence(3000, "long") + shared[3])]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_equals_the_rule(spark, rows, keep, monkeypatch):
    want = expected(rows, 40, keep)
    assert sum(r[2] for r in want) > 3000
    assert found(spark, rows, 40, keep, 16) == want
    # Small blocks, shards and groups change nothing: groups are split down to single windows.
    for name, value in (("BLOCK_WINDOWS", 256), ("CHUNK_BYTES", 500), ("SHARD_BYTES", 2000), ("GROUP_SEGMENTS", 2)):
        monkeypatch.setattr(sd, name, value)
    assert found(spark, rows, 40, keep, 16) == want


def test_null_ids_and_empty_tables(spark, sentence):
    text = sentence(40, "n")
    rows = [(None, text), (None, text), (3, text + " tail")]
    assert found(spark, rows, 40, "none", 16) == expected(rows, 40, "none")
    got = found(spark, rows, 40, "first", 16)
    assert [(r[0], r[2] > 0) for r in got] == [(3, False), (None, True), (None, True)]
    assert found(spark, [], 40, "none", 16) == []


def test_factors_equal_plain_search():
    rng = np.random.default_rng(3)
    for _ in range(150):
        flat = rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(1, 90))).astype(np.uint8)
        depth = int(rng.integers(1, 40))
        levels = sd.prefix_ranks(flat, depth)
        data = flat.tobytes()

        def prefix(i):
            return (data[i:i + depth] + bytes(depth))[:depth]

        last = levels[-1][1]
        order = sorted(range(len(data)), key=prefix)
        assert [prefix(i) for i in np.argsort(last, kind="stable")] == [prefix(i) for i in order]
        assert len(set(last.tolist())) == len({prefix(i) for i in order})
        at = np.arange(len(data))
        suffixes = np.argsort(last, kind="stable")

        def match(i, j):
            n = 0
            while n < depth and max(i, j) + n < len(data) and data[i + n] == data[j + n]:
                n += 1
            return n

        got = sd.longest_previous(flat, levels, at, suffixes, suffixes)
        assert got.tolist() == [max([match(i, j) for j in range(i)], default=0) for i in range(len(data))]
        later = sd.longest_previous(flat, levels, at, suffixes, len(at) - 1 - suffixes)
        assert later.tolist() == [max([match(i, j) for j in range(i + 1, len(data))], default=0) for i in range(len(data))]


def test_previous_smaller():
    rng = np.random.default_rng(4)
    cases = [rng.permutation(int(n)) for n in rng.integers(0, 300, 60)] + [np.append(np.arange(1, 500), 0), np.arange(500)[::-1]]
    for values in cases:
        want = [max([j for j in range(i) if values[j] < values[i]], default=-1) for i in range(len(values))]
        assert sd.previous_smaller(values).tolist() == want
