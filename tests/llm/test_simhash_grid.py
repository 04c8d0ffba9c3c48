import random

import numpy as np
import pyarrow as pa
import xxhash
from conftest import SF_SMALL
from llm_cases import LONG, documents, lower, no_documents, words

from strata.llm import simhash_grid as S
from strata.llm.queries import op13_simhash_grid


def fingerprint(text):
    w = words(lower(text))
    runs = [w[i : i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values):
    """The smallest member of each value's component, by comparing all pairs."""
    values = sorted(values)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                p, q = root(a), root(b)
                parent[max(p, q)] = min(p, q)
    return {v: root(v) for v in values}


def expected(rows):
    prints = [(d, fingerprint(t)) for d, t in rows]
    root = brute_components({f for _, f in prints})
    least = {}
    for d, f in prints:
        if d is not None:
            least[root[f]] = min(d, least.get(root[f], d))
    return sorted(((d, f"{f:016x}", least.get(root[f])) for d, f in prints), key=str)


def check(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = S.simhash_components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(rows)


def test_given_documents_and_hard_cases(spark):
    check(documents(spark, SF_SMALL))


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op13_simhash_grid(spark, SF_SMALL).collect()), key=str) == expected(rows)


def test_fingerprints_of_one_very_long_text(monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 1000)
    texts = [LONG, None, "a", LONG + " more", "", "x y"]
    assert S.fingerprints(pa.array(texts)).tolist() == [fingerprint(t) for t in texts]


def near(seed, n, spread):
    """Fingerprints a few random bits away from some centres."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)] + [0, (1 << 64) - 1]
    out = set()
    while len(out) < n:
        f = rng.choice(centres)
        for _ in range(rng.randrange(spread + 1)):
            f ^= 1 << rng.randrange(64)
        out.add(f)
    return sorted(out)


def joined(spark, values):
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    nodes = spark.createDataFrame([(v,) for v in signed], "node long").repartition(3)
    found = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in S.links(nodes).collect()]
    assert all(0 < (u ^ v).bit_count() <= 2 * len(values) for u, v in found)
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in found:
        p, q = root(u), root(v)
        parent[max(p, q)] = min(p, q)
    return {v: root(v) for v in values}


def test_links_hold_components_together_at_every_refinement(spark, monkeypatch):
    for cell in (2, 12, 256):
        monkeypatch.setattr(S, "CELL", cell)
        for spread in (2, 4):
            values = near(spread, 300, spread)
            assert joined(spark, values) == brute_components(values)


def test_a_group_of_near_copies_sends_few_links(spark):
    values = [1 << a | 1 << b for a in range(64) for b in range(a)]  # all within four bits, centre missing
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    n = S.links(spark.createDataFrame([(v,) for v in signed], "node long").repartition(3)).count()
    assert n < 70 * len(values)
    assert joined(spark, values) == brute_components(values)


def test_cells_of_close_prints_meet():
    rng = random.Random(3)
    for segments in S.GRIDS:
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), rng.randrange(3)):
                b ^= 1 << bit
            rows, keys = S.cells(np.array([a, b], np.uint64), segments)
            assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())
            assert len(keys) == len(set(zip(rows.tolist(), keys.tolist())))


def test_hot_print_and_null_ids(spark):
    rows = [(i, "one text that a third of all rows have in common") for i in range(50)] + [(None, "nothing else is near this one"), (None, None), (70, "")]
    rows += [(100 + i, f"row {i} has words {i * 7} of its own {i * i}") for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_empty_table(spark):
    assert S.simhash_components(no_documents(spark)).count() == 0
