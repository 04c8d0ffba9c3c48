import random
import re
from collections import Counter

import numpy as np
from conftest import SF_SMALL
from llm_cases import documents, no_documents

from strata.llm import decontaminate as D


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def true_pairs(rows, items):
    """Documents and items that overlap by the definition, on any diagonal, however they could be found."""
    out = set()
    for d, text in rows:
        w = tokens(text)
        at = {}
        for i, t in enumerate(w):
            at.setdefault(t, []).append(i)
        for item, item_text in items:
            x = tokens(item_text)
            least = min(13, len(x))
            diagonals = Counter(i - j for j, t in enumerate(x) for i in at.get(t, ()))
            for diagonal, n in diagonals.items():
                if 5 * n < 4 * least:
                    continue
                lo, hi = max(diagonal, 0), min(diagonal + len(x), len(w))
                total = [0]
                for i in range(lo, hi):
                    total.append(total[-1] + (1 if w[i] == x[i - diagonal] else -4))
                low = float("inf")
                for end in range(least, hi - lo + 1):
                    low = min(low, total[end - least])
                    if total[end] >= low:
                        out.add((d, item))
                        break
    return out


def assert_overlaps(got, rows, items):
    """Each row is an overlap as the definition says. Rows of repeated ids may stand for any text of the id."""
    texts, named = {}, {}
    for d, t in rows:
        texts.setdefault(d, []).append(tokens(t))
    for i, t in items:
        named.setdefault(i, []).append(tokens(t))
    for d, item, start, end, at, n_match, n_overlaps in got:
        assert n_overlaps >= 1 and 5 * n_match >= 4 * (end - start)
        assert any(
            end - start >= min(13, len(x)) and at + end - start <= len(x) and end <= len(w) and sum(a == b for a, b in zip(w[start:end], x[at:])) == n_match
            for w in texts[d] for x in named[item]
        )


def planted(seed):
    rng = random.Random(seed)
    prose = lambda n: [f"p{rng.randrange(2000)}" for _ in range(n)]
    items = [(k, " ".join(f"i{k}x{rng.randrange(60)}" for _ in range(rng.choice([4, 8, 13, 20, 45])))) for k in range(12)]
    items += [(100, items[3][1]), (101, None), (102, "")]
    rows = []
    for d in range(60):
        w = prose(rng.randrange(5, 60))
        for _ in range(rng.randrange(3)):
            part = tokens(rng.choice(items[:12])[1])
            part = part[rng.randrange(3) :]
            for k in range(len(part)):
                if rng.random() < 0.1:
                    part[k] = "changed"
            a = rng.randrange(len(w))
            w[a:a] = [t.upper() + rng.choice(["", ".", ", -"]) for t in part]
        rows.append((d, " ".join(w)))
    return rows, items


def collected(docs, benchmark):
    return sorted(tuple(r) for r in D.find_contamination(docs, benchmark).collect())


def test_planted_passages_with_substitutions(spark, monkeypatch):
    rows, items = planted(5)
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = collected(docs, benchmark)
    expected = true_pairs(rows, [(i, t) for i, t in items if t])
    assert len(expected) > 30
    assert {g[:2] for g in got} == expected
    assert_overlaps(got, rows, items)
    monkeypatch.setattr(D, "BLOCK_TOKENS", 20)  # many blocks give the same
    assert collected(docs, benchmark) == got


def test_recall_by_item_length(spark):
    """Items laid into prose with as many substitutions as an overlap may have, at random places."""
    rng = random.Random(11)
    lengths = [*range(1, 13), 13, 14, 16, 20, 30]
    items = [(n, " ".join(f"n{n}x{k}" for k in range(n))) for n in lengths]
    rows = []
    for n, text in items:
        for k in range(40):
            part = tokens(text)
            for at in rng.sample(range(n), n - -(-4 * n // 5)):
                part[at] = "changed"
            rows.append((1000 * n + k, " ".join([*(f"p{rng.randrange(99)}" for _ in range(rng.randrange(30))), *part, "after"])))
    got = collected(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    expected = true_pairs(rows, items)
    found = {g[:2] for g in got}
    assert found <= expected
    for n in lengths:
        of = {e for e in expected if e[1] == n}
        assert len(of) >= 40
        recall = len(found & of) / len(of)
        assert recall == 1 if n < 13 else recall >= 0.9, (n, recall)


def test_passages_of_one_diagonal_count_each(spark):
    item = [f"i{k}" for k in range(60)]
    text = item[:20] + [f"x{k}" for k in range(20)] + item[40:]
    docs = spark.createDataFrame([(1, " ".join(text)), (2, " ".join(item[:20]) + " gap " + " ".join(item[:20]))], "doc_id long, text string")
    got = collected(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string"))
    assert got == [(1, 7, 0, 20, 0, 20, 2), (2, 7, 0, 20, 0, 20, 2)]


def test_tiny_items_are_reported_but_drop_nothing(spark):
    docs = spark.createDataFrame([(1, "Yes, it is so."), (2, "nothing of the kind"), (3, "one two three four five six seven")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "yes"), (2, "it is so"), (3, "one two three CHANGED five six")], "item_id long, text string")
    assert [g[:2] for g in collected(docs, benchmark)] == [(1, 1), (1, 2), (3, 3)]
    assert sorted(r["doc_id"] for r in D.drop_contaminated(docs, benchmark).collect()) == [1, 2]
    assert [r["doc_id"] for r in D.drop_contaminated(docs, benchmark, least_tokens=1).collect()] == [2]


def test_given_documents_and_hard_cases(spark):
    docs, benchmark = documents(spark, SF_SMALL), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(r["item_id"], r["text"]) for r in benchmark.collect()]
    got = collected(docs, benchmark)
    assert {g[:2] for g in got} == true_pairs(rows, items)
    assert_overlaps(got, rows, items)
    whole = {(d, i) for d, t in rows for i, x in items if t and x in t}
    assert whole and whole <= {g[:2] for g in got}
    kept = D.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    gone = {g[0] for g in got}
    assert Counter(map(str, kept.collect())) == Counter(str(r) for r in docs.collect() if r["doc_id"] not in gone)


def test_empty_tables(spark):
    benchmark = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert D.find_contamination(no_documents(spark), benchmark).count() == 0
    assert D.find_contamination(documents(spark, SF_SMALL), benchmark.limit(0)).count() == 0
    assert D.drop_contaminated(documents(spark, SF_SMALL), benchmark.limit(0)).count() == documents(spark, SF_SMALL).count()


def overlaps(same, least):
    """All stretches of enough tokens and matches, from their definition."""
    n = len(same)
    return [(a, b) for a in range(n) for b in range(a + least, n + 1) if 5 * sum(same[a:b]) >= 4 * (b - a)]


def test_any_stretch_of_a_diagonal_counts():
    rng = np.random.default_rng(4)
    hidden = 0
    for _ in range(400):
        same = rng.random(rng.integers(1, 60)) < rng.choice([0.6, 0.75, 0.85])
        least = min(D.MIN_OVERLAP, len(same))
        every, (start, end, match) = overlaps(same.tolist(), least), D.best_stretch(same)
        assert match == same[start:end].sum()
        assert ((start, end) in every) == bool(every)
        score = np.append(0, np.cumsum(np.where(same, 1, -D.PENALTY)))
        hidden += bool(every) and score[end] - score[start] < (score - np.minimum.accumulate(score)).max()
    assert hidden > 10


def test_exact_runs_parted_by_substitutions(spark):
    items = [(k, " ".join(f"i{k}x{j}" for j in range(150))) for k in range(12)]
    runs = [f"i0x{j}" if j % 19 < 13 else "changed" for j in range(51)]
    rows = [(0, "before " + " ".join(runs) + " after")]
    rng = random.Random(8)
    for d in range(1, 60):
        part = [t if rng.random() < 0.78 else "changed" for t in tokens(items[d % 12][1])]
        rows.append((d, " ".join(part)))
    expected = {0} | {
        d for d, text in rows if d and overlaps([a == b for a, b in zip(tokens(text), tokens(items[d % 12][1]))], 13)
        and any(all(a == b for a, b in zip(tokens(text)[k : k + 6], tokens(items[d % 12][1])[k : k + 6])) for k in range(145))
    }
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = collected(docs, benchmark)
    assert expected <= {f[0] for f in found} and (0, 0) in {f[:2] for f in found}
    assert all(f[3] - f[2] >= 13 and f[5] >= D.MIN_IDENTITY * (f[3] - f[2]) for f in found)
    assert {r["doc_id"] for r in D.drop_contaminated(docs, benchmark).collect()} == set(range(60)) - {f[0] for f in found}


def test_items_without_an_id(spark):
    texts = [" ".join(f"n{k}x{j}" for j in range(20)) for k in range(3)]
    docs = spark.createDataFrame([(k, "some " + t) for k, t in enumerate(texts)] + [(9, "clean words")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (5, texts[2])], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"], r["n_match"]) for r in D.find_contamination(docs, benchmark).collect()} == {(0, None, 20), (1, None, 20), (2, 5, 20)}
    assert [r["doc_id"] for r in D.drop_contaminated(docs, benchmark).collect()] == [9]
