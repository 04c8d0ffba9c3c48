import math
from collections import Counter

import numpy as np
import pytest
from conftest import SF_ORACLE, SF_SMALL
from llm_cases import documents, fold, lower, no_documents, words

from strata.llm import brown_lm as B


def tokens(text):
    return [*words(lower(text)), "\n"]


def unigrams(rows):
    counts = Counter(t for d, text in rows if fold(d, 5) != 1 for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    return counts, total, lambda text: sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens(text))


@pytest.mark.parametrize("common", [100_000, 40])
def test_base_columns_equal_brute_force(spark, monkeypatch, common):
    # With few common words most words meet their counts in the join.
    monkeypatch.setattr(B, "COMMON_WORDS", common)
    docs = documents(spark, SF_SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts, total, score = unigrams(rows)
    expected = sorted((str(d), fold(d, 5) == 1, len(tokens(t)), sum(counts[x] > 0 for x in tokens(t)), total, round(score(t), 6)) for d, t in rows)
    got = B.score(docs).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def brute_force_scores(rows, clustered, classes):
    """The class model from plain counts, given the clustered words and their classes."""
    train = [tokens(t) for d, t in rows if fold(d, 5) != 1]
    of = lambda t: "end" if t == "\n" else classes.get(t, "other")
    words_, pairs, singles = Counter(), Counter(), Counter()
    for text in train:
        before = "end"
        for t in text:
            words_[t] += 1
            pairs[before, of(t)] += 1
            singles[of(t)] += 1
            before = of(t)
    names = [*set(classes.values()), "other", "end"]
    total, rows_ = sum(singles.values()), Counter()
    for (a, _), n in pairs.items():
        rows_[a] += n
    others = sum(n for t, n in words_.items() if of(t) == "other")
    kinds = sum(of(t) == "other" for t in words_)

    def probability(before, t):
        share = (singles[of(t)] + 0.5) / (total + 0.5 * len(names))
        follow = pairs[before, of(t)] / rows_[before] if rows_[before] else share
        step = B.BIGRAM_WEIGHT * follow + (1 - B.BIGRAM_WEIGHT) * share
        if of(t) == "end":
            return step
        if of(t) == "other":
            return step * (words_[t] + 0.5) / (others + 0.5 * (kinds + 1))
        return step * words_[t] / singles[of(t)]

    def score(text):
        out, before = 0.0, "end"
        for t in tokens(text):
            out += math.log10(probability(before, t))
            before = of(t)
        return out

    return score


def test_class_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(B, "COMMON_WORDS", 60)
    monkeypatch.setattr(B, "CLASS_WORDS", 30)
    monkeypatch.setattr(B, "CLASSES", 6)
    kept = {}
    fit = B.exchange_clusters
    monkeypatch.setattr(B, "exchange_clusters", lambda pairs, n, *a: kept.setdefault("of", fit(pairs, n, *a)))
    find = B.common_words
    monkeypatch.setattr(B, "common_words", lambda counts: kept.setdefault("vocabulary", find(counts)))
    docs = documents(spark, SF_SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = B.score(docs).collect()
    vocabulary = kept["vocabulary"]
    every = sorted({t for _, text in rows for t in words(lower(text))})
    from strata.llm.text import column_bytes, split_words, word_hashes

    import pyarrow as pa

    hashes = word_hashes(split_words(*column_bytes(pa.array(every)))).astype(np.int64)
    slots = vocabulary.slots(hashes)
    classes = {t: int(kept["of"][s]) for t, s in zip(every, slots) if s < vocabulary.size}
    assert 20 <= len(classes) <= 30
    score = brute_force_scores(rows, set(classes), classes)
    expected = sorted((str(d), round(score(t), 5)) for d, t in rows)
    assert sorted((str(r["doc_id"]), round(r["score"], 5)) for r in got) == expected


def test_classes_predict_held_out_texts_better_than_unigrams(spark):
    got = B.score(spark.read.parquet(f"{SF_ORACLE}/documents.parquet")).where("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def likelihood(pairs, of):
    table = B.class_pairs(pairs, of).astype(float)
    return B._xlogx(table).sum() - B._xlogx(table.sum(1)).sum() - B._xlogx(table.sum(0)).sum()


def test_exchange_stops_where_no_single_move_helps():
    rng = np.random.default_rng(2)
    pairs = rng.poisson(rng.choice([0.2, 6.0], (14, 14)))
    of = B.exchange_clusters(pairs, 4)
    best = likelihood(pairs, of)
    assert best >= likelihood(pairs, np.append(np.arange(12) % 4, [4, 5]))
    for w in range(12):
        for c in range(4):
            moved = of.copy()
            moved[w] = c
            assert likelihood(pairs, moved) <= best + 1e-6
    assert of[12:].tolist() == [4, 5]


def test_empty_table_and_no_training_rows(spark):
    assert B.score(no_documents(spark)).count() == 0
    held = next(d for d in range(100) if fold(d, 5) == 1)
    row = B.score(spark.createDataFrame([(held, "some words"), (held, None)], "doc_id long, text string")).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in row) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def every_word_scores(rows, classes, n_classes):
    """The model of all words from plain counts, given every training word's class."""
    pairs, counts = Counter(), Counter()
    for d, text in rows:
        if fold(d, 5) != 1:
            before = "end"
            for t in tokens(text):
                now = "end" if t == "\n" else classes[t]
                pairs[before, now] += 1
                counts[t] += 1
                before = now
    kinds = Counter(classes.values())
    real = [*kinds, "end"]
    seen = {c: sum(pairs[a, c] for a in real) for c in real}
    total = sum(seen.values())

    def chance(before, c):
        share = (seen[c] + 0.5) / (total + 0.5 * len(real))
        row = sum(pairs[before, x] for x in real)
        return B.BIGRAM_WEIGHT * (pairs[before, c] / row if row else share) + (1 - B.BIGRAM_WEIGHT) * share

    def score(text):
        out, before = 0.0, "end"
        for t in tokens(text):
            if t == "\n":
                out += math.log10(chance(before, "end"))
                before = "end"
            elif t in classes:
                c = classes[t]
                out += math.log10(chance(before, c) * (counts[t] + 0.5) / (seen[c] + 0.5 * (kinds[c] + 1)))
                before = c
            else:
                out += math.log10(sum(chance(before, c) * 0.5 / (seen[c] + 0.5 * (kinds[c] + 1)) for c in kinds))
                before = "unseen"
        return out

    return score


def best_by_hand(after, before, table, n_classes):
    """The class whose table of pairs has the highest likelihood once the word's pairs are in it."""

    def value(c):
        t = table.astype(float).copy()
        t[c] += after
        t[:, c] += before
        gain = B._xlogx(t).sum() - B._xlogx(table.astype(float)).sum()
        left, right = table.sum(1)[c].astype(float), table.sum(0)[c].astype(float)
        return gain - (B._xlogx(left + after.sum()) - B._xlogx(left)) - (B._xlogx(right + before.sum()) - B._xlogx(right))

    return [value(c) for c in range(n_classes)]


@pytest.mark.parametrize("common", [100_000, 60])
def test_every_training_word_has_the_class_of_the_highest_gain(spark, monkeypatch, common):
    from strata.llm.text import column_bytes, split_words, word_hashes

    import pyarrow as pa

    monkeypatch.setattr(B, "COMMON_WORDS", common)
    monkeypatch.setattr(B, "CLASS_WORDS", 30)
    monkeypatch.setattr(B, "CLASSES", 6)
    monkeypatch.setattr(B, "GAIN_WORDS", 50)
    kept = {}
    for name in ("exchange_clusters", "common_words", "word_classes"):
        monkeypatch.setattr(B, name, lambda *a, f=getattr(B, name), name=name: kept.setdefault(name, (f(*a), a))[0])
    docs = documents(spark, SF_SMALL)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = B.score(docs, every_word=True).collect()
    of, vocabulary, table = kept["exchange_clusters"][0], kept["common_words"][0], kept["word_classes"][1][1]
    assigned = {r["word"]: r["class"] for r in kept["word_classes"][0].collect()}
    every = sorted({t for d, text in rows if fold(d, 5) != 1 for t in words(lower(text))})
    hashes = word_hashes(split_words(*column_bytes(pa.array(every)))).astype(np.int64)
    slots = vocabulary.slots(hashes).tolist()
    core = {t: int(of[s]) for t, s in zip(every, slots) if s < vocabulary.size}
    classes = {t: core[t] if t in core else assigned[h] for t, h in zip(every, hashes.tolist())}
    assert len(classes) == len(every) > 10 * len(core)

    n = len(table)
    around = {t: np.zeros((2, n)) for t in every if t not in core}
    for d, text in rows:
        if fold(d, 5) != 1:
            codes = [n - 1, *[n - 1 if t == "\n" else core.get(t, n - 2) for t in tokens(text)]]
            for k, t in enumerate(tokens(text)[:-1]):
                if t in around:
                    around[t][0, codes[k + 2]] += 1
                    around[t][1, codes[k]] += 1
    for t, (after, before) in around.items():
        gains = best_by_hand(after, before, table, n - 2)
        assert gains[classes[t]] >= max(gains) - 1e-6, t

    score = every_word_scores(rows, classes, n - 2)
    assert sorted((str(r["doc_id"]), round(r["score"], 5)) for r in got) == sorted((str(d), round(score(t), 5)) for d, t in rows)
    base = B.score(docs).drop("score").collect()
    flat = lambda rs: sorted(tuple(round(v, 5) if isinstance(v, float) else str(v) for v in (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"])) for r in rs)
    assert flat(got) == flat(base)


def test_classes_of_every_word_predict_held_out_texts_better(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    got = B.score(docs, every_word=True).where("held_out").collect()
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_every_word_of_empty_tables(spark):
    assert B.score(no_documents(spark), every_word=True).count() == 0
    held = next(d for d in range(100) if fold(d, 5) == 1)
    row = B.score(spark.createDataFrame([(held, "some words"), (held, None)], "doc_id long, text string"), every_word=True).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in row) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(math.isfinite(r["score"]) for r in row)


def test_texts_longer_than_a_slice_score_as_brute_force(spark, monkeypatch):
    """Long texts among short ones and empty ones; most words meet their classes in the join, and equal texts score alike."""
    monkeypatch.setattr(B, "COMMON_WORDS", 20)
    some = np.random.default_rng(5).zipf(1.3, B.TOKENS + 1000) % 997
    long = " ".join(f"w{k}" for k in some)
    texts = [long, "w1 w2 W3", None, long, "never seen before", "", long[: len(long) // 3], "w1 w2 W3", long]
    rows = list(enumerate(texts))
    _, _, score = unigrams([(d, t or "") for d, t in rows])
    counts = unigrams([(d, t or "") for d, t in rows])[0]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r for r in B.score(docs, every_word=True).collect()}
    assert sorted(got) == list(range(len(texts)))
    for d, t in rows:
        own = tokens(t or "")
        assert (got[d]["n_tokens"], got[d]["n_known"]) == (len(own), sum(counts[x] > 0 for x in own))
        assert math.isclose(got[d]["base_score"], score(t or ""), rel_tol=1e-9)
        assert math.isclose(got[d]["score"], got[texts.index(t)]["score"], rel_tol=1e-9)
