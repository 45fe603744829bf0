"""Removed words against a direct reading of the rule; the automaton against substring search."""

import random

from reviewscope.llm import substring_dedup as sd


def expected(rows):
    first = {}
    for key, text in rows:
        w = sd.words_of(text or "")
        for i in range(len(w) - sd.LENGTH + 1):
            if key is not None:
                k = tuple(w[i:i + sd.LENGTH])
                first[k] = min(first.get(k, key), key)
    out = []
    for key, text in rows:
        w = sd.words_of(text or "")
        gone = set()
        for i in range(len(w) - sd.LENGTH + 1):
            if key is not None and first[tuple(w[i:i + sd.LENGTH])] < key:
                gone |= set(range(i, i + sd.LENGTH))
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def found(docs):
    return [
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in sd.dedup_passages(docs).collect()
    ]


def check(docs_of, rows):
    want = sorted(expected(rows), key=str)
    got = found(docs_of([(k, t, None, None, 0) for k, t in rows]))
    whole = {k: " ".join(sd.words_of(t or "")) for k, t in rows}
    got = [(k, n, g, whole[k] if g == 0 else t) for k, n, g, t in got]
    assert sorted(got, key=str) == want


def test_equals_the_rule(docs_of, sentence):
    rng = random.Random(1)
    shared = [sentence(n, f"p{n}") for n in (49, 50, 51, 80, 200)]
    rows = []
    for i in range(60):
        parts = [sentence(rng.randrange(0, 120), f"d{i}")]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(shared), sentence(rng.randrange(0, 30), f"e{i}{len(parts)}")]
        rows.append((i, " ".join(parts)))
    # Slots: each pair shares a window that the first document lacks.
    a, b, c = sentence(30, "a"), sentence(45, "b"), sentence(30, "c")
    rows += [(100, f"{a} {b} x1"), (101, f"y1 {b} {c}"), (102, f"{a} {b} {c}"), (103, f"zz {b} {c}")]
    rows += [(200 + i, rows[0][1] + " " + shared[4]) for i in range(5)] + [(300, "the " * 400), (301, "the " * 120 + shared[3])]
    rows += [(400, ""), (401, None), (402, "few words"), (403, "few words")]
    check(docs_of, rows)


def test_null_and_repeated_ids(docs_of, sentence):
    long = sentence(90, "n")
    check(docs_of, [(None, long), (5, long)])
    check(docs_of, [(5, long), (5, long), (6, long)])
    assert found(docs_of([])) == []


def test_many_tasks_per_shard_change_nothing(docs_of, sentence, monkeypatch):
    monkeypatch.setattr(sd, "SHARD_WORDS", 30)
    monkeypatch.setattr(sd, "TASK_WORDS", 100)
    rows = [(i, f"{sentence(20, i)} {sentence(70, 'hot')} {sentence(20, -i - 1)}") for i in range(30)]
    check(docs_of, rows)


def test_automaton_spans():
    rng = random.Random(2)
    for _ in range(200):
        passages = [[rng.choice("ab") for _ in range(rng.randrange(1, 15))] for _ in range(4)]
        words = [rng.choice("abc") for _ in range(30)]
        automaton = sd.SuffixAutomaton()
        for p in passages:
            automaton.add(p)
        grams = {tuple(p[i:i + 4]) for p in passages for i in range(len(p) - 3)}
        covered = {j for i in range(27) if tuple(words[i:i + 4]) in grams for j in range(i, i + 4)}
        assert {j for a, b in automaton.spans(words, 4) for j in range(a, b)} == covered
