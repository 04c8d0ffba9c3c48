import hashlib
import random

import pytest
from conftest import SF_SMALL
from llm_cases import documents, no_documents, words

from strata.llm import substring_dedup as S


def brute_force(rows):
    """Results of (doc_id, text) rows; equal rows are one document, rows of one id stand in the operator's order."""
    seen, out = set(), {}
    for doc_id, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - S.WINDOW + 1):
            window = tuple(w[i : i + S.WINDOW])
            if window in seen:
                gone.update(range(i, i + S.WINDOW))
            seen.add(window)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[doc_id, text] = len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()
    return out


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute_force(sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)))
    by_id = {}
    for (doc_id, _), v in expected.items():
        by_id.setdefault(doc_id, v)
    got = S.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_removed"], r["kept"], r["kept_sha256"]) == by_id[r["doc_id"]]


def test_given_documents_and_hard_cases(spark):
    check(documents(spark, SF_SMALL))


def edited(seed, n_docs):
    """Copies of a few passages, cut and edited at random."""
    rng = random.Random(seed)
    base = [[f"p{p}w{rng.randrange(400)}" for _ in range(rng.randrange(15, 120))] for p in range(6)]
    rows = []
    for d in range(n_docs):
        text = []
        for _ in range(rng.randrange(1, 4)):
            part = list(rng.choice(base))
            a = rng.randrange(len(part))
            part = part[a:] if rng.random() < 0.4 else part[: a + 1]
            if part and rng.random() < 0.6:
                part[rng.randrange(len(part))] = f"e{rng.randrange(50)}"
            text += part
        rows.append((d, " ".join(text)))
    return rows


@pytest.mark.parametrize("limit", [2000, 1])
def test_random_edits(spark, monkeypatch, limit):
    # With a limit of 1 every shard of several contexts is split by window.
    monkeypatch.setattr(S, "SHARD_CONTEXTS", limit)
    for seed in range(3):
        check(spark.createDataFrame(edited(seed, 60), "doc_id long, text string").repartition(4))


def test_a_window_that_all_documents_hold(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD_CONTEXTS", 50)
    passage = " ".join(f"shared{i}" for i in range(22))
    rng = random.Random(2)
    own = lambda: " ".join(f"o{rng.randrange(10**6)}" for _ in range(15))
    docs = spark.createDataFrame([(d, f"{own()} {passage} {own()}") for d in range(3000)] + [(None, passage)], "doc_id long, text string").repartition(6)
    held = {}
    shards, windows = S._match_shards, S._match_windows
    monkeypatch.setattr(S, "_match_shards", lambda rows: (held.setdefault("contexts", rows), shards(rows))[1])
    monkeypatch.setattr(S, "_match_windows", lambda rows: (held.setdefault("windows", rows), windows(rows))[1])
    check(docs)
    assert held["windows"].count() > 3000  # the windows around the passage
    for rows, most in ((held["contexts"], 50), (held["windows"], 12)):
        counts = [r["count"] for r in rows.groupBy("shard").count().collect()]
        assert max(counts, default=0) <= most


def test_rows_of_one_id_and_text_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(50))
    got = S.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, 50)]


def test_empty_table(spark):
    assert S.remove_repeats(no_documents(spark)).count() == 0


def test_automaton_gives_matching_statistics():
    rng = random.Random(3)
    for _ in range(60):
        held = [[rng.randrange(3) for _ in range(rng.randrange(1, 14))] for _ in range(rng.randrange(1, 5))]
        automaton = S.SuffixAutomaton()
        for h in held:
            automaton.add(h)
        probe = [rng.randrange(4) for _ in range(20)]
        inside = lambda x: any(h[i : i + len(x)] == x for h in held for i in range(len(h)))
        expected = [max(n for n in range(i + 2) if n == 0 or inside(probe[i + 1 - n : i + 1])) for i in range(len(probe))]
        assert automaton.matching_lengths(probe) == expected
