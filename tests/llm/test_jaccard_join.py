import random

import numpy as np
from conftest import SF_SMALL
from llm_cases import documents, lower, no_documents, words

from strata.llm import jaccard_join as J


def shingles(text):
    w = words(lower(text))
    if len(w) < J.GRAM:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + J.GRAM]) for i in range(len(w) - J.GRAM + 1)}


def brute_force(rows):
    """Component of every id by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            n = len(x & y)
            if x and y and 100 * n >= J.PERCENT * (len(x) + len(y) - n):
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in parent}


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    label = brute_force(rows)
    expected = sorted((d, len(shingles(t)), label.get(d)) for d, t in rows if d is not None)
    got = J.jaccard_components(docs).collect()
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None) == expected
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None] * (len(rows) - len(expected))


def test_given_documents_and_hard_cases(spark):
    check(documents(spark, SF_SMALL))


def near_copies(seed, n):
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        w = [f"t{rng.randrange(3)}b{i}" if rng.random() < 0.03 else f"b{i}" for i in range(rng.choice([12, 40, 41, 60]))]
        if rng.random() < 0.3:
            w = w[: -rng.randrange(1, 9)]
        rows.append((rng.randrange(10**6) * 10 + d % 7, " ".join(w)))
    return rows


def test_chains_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SETS", 5)
    for seed in range(2):
        check(spark.createDataFrame(near_copies(seed, 90), "doc_id long, text string").repartition(3))


def test_rows_of_one_id_are_one_node(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(7, a), (7, b), (9, a), (8, b), (3, "other words than those here")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in J.jaccard_components(docs).collect()}
    assert got == {(7, 7), (9, 7), (8, 7), (3, 3)}


def test_empty_table(spark):
    assert J.jaccard_components(no_documents(spark)).count() == 0


def test_trie_finds_exactly_the_linked_sets():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 10**6, 60).astype(np.uint64))
    sets = []
    for _ in range(120):
        s = base[rng.random(len(base)) > rng.choice([0.02, 0.1])]
        sets.append(np.unique(np.concatenate([s, rng.integers(0, 10**6, rng.integers(0, 6)).astype(np.uint64)])))
    trie = J.Trie(np.zeros(0, np.uint64))
    for k, s in enumerate(sets):
        trie.add(s, k)
    for s in sets[:20]:
        both = [len(np.intersect1d(s, t)) for t in sets]
        expected = [k for k, (t, n) in enumerate(zip(sets, both)) if 100 * n >= J.PERCENT * (len(s) + len(t) - n)]
        assert sorted(trie.linked(s)) == expected


def test_width_and_percentage_are_parameters(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for d in range(0, 120, 3):
        w = [f"u{rng.randrange(5000)}" for _ in range(40)]
        rows.append((d, " ".join(w)))
        for k in (1, 2):
            x = list(w)
            for _ in range(rng.randrange(3)):
                x[rng.choice([0, 1, 2, 37, 38, 39])] = f"c{rng.randrange(5000)}"
            rows.append((d + k, " ".join(x)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    label = lambda *a: {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs, *a).collect()}
    expected = {}
    for gram, percent in ((4, 85), (5, 80)):
        monkeypatch.setattr(J, "GRAM", gram)
        monkeypatch.setattr(J, "PERCENT", percent)
        expected[gram, percent] = brute_force(rows)
    monkeypatch.undo()
    assert label() == expected[4, 85] and label(5, 80) == expected[5, 80]
    assert expected[4, 85] != expected[5, 80]
