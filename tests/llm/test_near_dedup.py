"""Components against all pairs; sketches; connected components against union-find."""

import itertools
import random

import numpy as np
import pytest

from reviewscope.llm import near_dedup as nd
from reviewscope.llm import components
from reviewscope.llm.components import connected_components, merged_components


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").translate(str.maketrans(nd.UPPER, nd.LOWER)).split()
        out.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set()))
    return out


def components_of(n, links):
    label = list(range(n))
    for _ in range(n):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_equals_all_pairs(docs_of, sentence):
    rng = random.Random(3)
    texts = [sentence(120, i) for i in range(4)]
    for base in range(4):
        for i in range(25):
            words = texts[base].split()
            for _ in range(rng.choice([1, 1, 2, 3, 6])):
                words[rng.randrange(len(words))] = f"new{base}x{i}"
            texts.append(" ".join(words))
    texts += [texts[0], texts[0].upper(), "", None, "", "one two", "One TWO", "a b c d", "x", " \t "]
    sets = sets_of(texts)
    links = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    label = components_of(len(texts), links)
    for r in nd.near_duplicates(docs_of(texts)).collect():
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[i]), label[i], label[i] == i)


def test_odd_rows(docs_of, sentence):
    long = sentence(60, 9)
    rows = [(None, long, None, None, 0), (7, long, None, None, 0), (7, long, None, None, 0), (None, "only here once again", None, None, 0), (None, None, None, None, 0)]
    out = nd.near_duplicates(docs_of(rows)).collect()
    assert sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in out), key=str) == sorted(
        [(None, 7, False), (7, 7, True), (7, 7, True), (None, None, True), (None, None, True)], key=str)
    assert nd.near_duplicates(docs_of([])).collect() == []


def overlapping(rng, size, similarity):
    """Two sets of ``size`` random hashes."""
    inside = round(size * 2 * similarity / (1 + similarity))
    pool = rng.integers(1, 2**63, 2 * size - inside, dtype=np.uint64)
    return pool[:size], pool[size - inside:]


def pairs_frame(spark, pairs):
    rows = [tuple(v for x in pair for v in (len(x), nd.odd_sketch(nd.bin_samples(x)).tolist())) for pair in pairs]
    return spark.createDataFrame(rows, "a_n long, a_sketch array<long>, b_n long, b_sketch array<long>")


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.9])
def test_sketches_tell_similarity(spark, similarity):
    a, b = overlapping(np.random.default_rng(1), 4000, similarity)
    df = pairs_frame(spark, [(a, b)])
    load = len(np.union1d(a, b)) / nd.BINS
    tosses = nd.BINS * (1 - np.exp(-load)) * (1 - similarity) * (2 - load / np.expm1(load))
    bits = df.select(nd.differing_bits("a_sketch", "b_sketch")).first()[0]
    assert bits == pytest.approx(1024 * (1 - np.exp(-2 * tosses / 2048)), abs=80)
    assert df.select(nd.look_alike("a_", "b_")).first()[0] == (similarity > 0.7)
    assert np.array_equal(nd.minhashes(a, block=1 << 10), nd.minhashes(a))


@pytest.mark.parametrize("size", [9, 18, 45, 144, 900, 9000, 90000])
def test_sketches_keep_pairs_at_the_threshold(spark, size):
    """At three deviations nearly all pass, at five all; well below the threshold hardly any do."""
    rng = np.random.default_rng(size)
    times = 400 if size < 10000 else 60
    df = pairs_frame(spark, [overlapping(rng, size, 0.8) for _ in range(times)])
    three, five = df.select(*[nd.look_alike("a_", "b_", d).cast("int").alias(f"d{d}") for d in (3, 5)]).groupBy().sum().first()
    assert three >= 0.99 * times and five == times
    if size >= 144:
        far = pairs_frame(spark, [overlapping(rng, size, 0.68) for _ in range(times)])
        assert far.where(nd.look_alike("a_", "b_")).count() <= 0.02 * times


def test_components_of_chains_stars_and_copies(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(101, 100)]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = sorted({n for a, b in links if a != b for n in (a, b)})
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label


def test_unlike_texts_seldom_share_a_bucket():
    """Chance buckets grow with the square of the texts; those of pairs at the threshold must stay."""
    rng = np.random.default_rng(11)

    def sharing(similarity):
        pairs = [overlapping(rng, 300, similarity) for _ in range(300)]
        return np.mean([len(np.intersect1d(*[nd.band_keys(nd.minhashes(x)) for x in p])) > 0 for p in pairs])

    assert sharing(0.2) <= 0.02 and sharing(0.3) <= 0.1 and sharing(0.8) == 1


def test_stars_need_no_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr(components, "materialize", lambda df, name: made.append(name) or df)
    links = spark.createDataFrame([(1, i) for i in range(2, 9)] + [(10, 11)], "a bigint, b bigint")
    assert sorted(connected_components(links).collect()) == [(i, 1) for i in range(1, 9)] + [(10, 10), (11, 10)]
    assert made == ["links"]


def test_further_links_join_components(spark):
    found = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node bigint, component bigint")
    links = spark.createDataFrame([(6, 2), (2, 1), (20, 6), (31, 30)], "a bigint, b bigint")
    assert sorted(merged_components(found, links).collect()) == [(1, 1), (2, 1), (5, 1), (6, 1), (8, 8), (9, 8), (20, 1), (30, 30), (31, 30)]
    assert sorted(merged_components(found, links.limit(0)).collect()) == sorted(found.collect())


def test_crowds_of_other_texts(docs_of, sentence, monkeypatch):
    """Buckets larger than FEW, with leaders until they find no link."""
    texts = [f"{b} end{i} x{i}" for b in [sentence(80, i) for i in range(3)] for i in range(12)]
    monkeypatch.setattr(nd, "FEW", 2)
    monkeypatch.setattr(nd, "FEW_PAIRS", 0)
    out = sorted(nd.near_duplicates(docs_of(texts)).collect(), key=lambda r: r["doc_id"])
    assert [r["component_id"] for r in out] == [i // 12 * 12 for i in range(36)]


def test_members_of_many_crowds_meet_few_leaders(spark, monkeypatch):
    """Every bucket has leaders of its own; a node in 20 of them still meets three."""
    rng, met = random.Random(4), []
    rows = [(b, n, n % 7, n) for n in range(60) for b in rng.sample(range(60), 20)]
    members = spark.createDataFrame(rows, "bucket long, node long, fame long, component long")
    sketch = nd.odd_sketch(np.arange(1, 300, dtype=np.uint64)).tolist()
    nodes = spark.createDataFrame([(n, 300, sketch) for n in range(60)], "node long, n long, sketch array<long>")
    with_sketches = nd._with_sketches
    monkeypatch.setattr(nd, "_with_sketches", lambda pairs, nodes: met.extend(pairs.collect()) or with_sketches(pairs, nodes))
    assert nd._leader_pairs(members, nodes, 0).count() == 60
    assert len(met) == len(set(met)) <= 60 * nd.MEETS and all(a != b for a, b in met)
    buckets = {n: {r[0] for r in rows if r[1] == n} for n in range(60)}
    assert all(buckets[a] & buckets[b] for a, b in met)


def test_pairs_are_confirmed_with_and_without_broadcast(spark, monkeypatch):
    sets = nd.materialize(spark.createDataFrame([(i, list(range(i, i + 20))) for i in range(40)], "node long, shingles array<long>"), "sets")
    pairs = nd.materialize(spark.createDataFrame([(0, 1), (0, 2), (0, 3), (5, 7), (9, 6), (30, 39)], "a long, b long"), "pairs")
    want = [(0, 1), (0, 2), (5, 7)]
    seldom = nd.confirm(pairs, sets)
    assert sorted(map(tuple, seldom.collect())) == want and "Broadcast" in seldom._jdf.queryExecution().toString()
    monkeypatch.setattr(nd, "LISTED", 2)
    assert sorted(map(tuple, nd.confirm(pairs, sets).collect())) == want


def test_own_rows_are_shuffled_once(spark):
    """Repeated rows of a node leave without a second shuffle by node."""
    rows = nd.materialize(spark.createDataFrame([(k, f"t{k % 3}") for k in (0, 1, 2, 3, 4, 5, 0, 1)] + [(None, "u"), (None, "u")], "key long, same string"), "rows")
    owners = nd.materialize(spark.createDataFrame([(k, f"t{k}") for k in range(3)] + [(nd.NO_ID + 4, "u")], "node long, same string"), "owners")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = nd._owned(rows, owners).select("node", "same")
        assert sorted(map(tuple, own.collect())) == [(0, "t0"), (1, "t1"), (2, "t2"), (nd.NO_ID + 4, "u")]
        plan = own._jdf.queryExecution().sparkPlan().toString()
        assert "hashpartitioning(node" not in own._jdf.queryExecution().toString() and plan.count("Join") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
