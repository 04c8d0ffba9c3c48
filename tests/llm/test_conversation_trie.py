import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from llm_cases import words
from pyspark.sql import types as T

from strata.llm import conversation_trie as C
from strata.llm.oracles import ORACLE_SQL
from strata.llm.queries import op12_conversation_trie

SCHEMA = T.StructType([
    T.StructField("node", T.StringType()),
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("depth", T.StringType()),
    T.StructField("words", T.StringType()),
])


def table(spark, rows, parts=3):
    return spark.createDataFrame([("n", *r, "d", "w") for r in rows], SCHEMA).repartition(parts)


def brute_force(rows):
    def digest(r):
        return hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()

    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r[2], r[3]) for r in sorted(t, key=lambda r: (r[0], r[1], digest(r)))] for c, t in own.items()}
    built = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h]) + tuple(t[h:])
    members = {}
    for c, t in built.items():
        for d in range(len(t) + 1):
            members.setdefault(t[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        gain = (len(members[p]) - 1) * (len(words(p[-1][1])) if p else 0)
        kids = [below(q) for q in children.get(p, [])]
        return (sum(k[0] for k in kids) or 1), gain + sum(k[1] for k in kids)

    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *below(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    assert df.columns == C.RESULT
    return sorted((tuple(r) for r in df.collect()), key=str)


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


def hard():
    rows = [(None, 0, "user", "no id")] + [(40, None, "user", "null first"), (40, 1, None, None), (40, 1, None, None), (40, 2, "", "")]
    rows += [(41, 5, "user", "a b"), (41, 5, "assistant", "a b"), (41, 5, "user", "a b"), (57, 1, "user", "one turn without a base")]
    rows += [(-3, 1, "user", "below zero"), (-3, 2, "assistant", "x\ty"), (-21, 1, "user", "below zero")]
    rows += [(9000 + i, k, "user", f"same {k}") for i in range(40) for k in range(6)]  # a hot conversation
    rows += [(60, k, "user", f"turn {k % 3} " + "long " * (k % 50)) for k in range(700)] + [(80, 0, "system", "word " * 50_000)]
    return rows


def test_query_and_its_sql(spark):
    got = found(op12_conversation_trie(spark, SF_SMALL))
    assert got == brute_force(given(spark))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    assert sorted(con.sql(f"SELECT {', '.join(C.RESULT)} FROM ({ORACLE_SQL['op12_conversation_trie']})").fetchall(), key=str) == got


def test_hard_rows(spark):
    rows = given(spark) + hard()
    assert found(C.prefix_trie(table(spark, rows))) == brute_force(rows)


@pytest.mark.parametrize("seed", range(3))
def test_shared_prefixes_over_many_small_pieces(spark, monkeypatch, seed):
    monkeypatch.setattr(C, "SHARD_NODES", 7)
    monkeypatch.setattr(C, "ROWS", 11)
    monkeypatch.setattr(C, "PIECE", 20)
    rng = random.Random(seed)
    rows = [(c, k, rng.choice(["user", "assistant"]), rng.choice(["a", "b b", "c c c"])) for c in rng.sample(range(400), 150) for k in range(rng.randrange(1, 8))]
    assert found(C.prefix_trie(table(spark, rows))) == brute_force(rows)


def test_empty_table(spark):
    assert C.prefix_trie(table(spark, [])).count() == 0
    assert C.prefix_trie(table(spark, [(None, 1, "user", "x")])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_slots_are_minimal_and_verified(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64), axis=0)
    nodes = C.NodeTable(keys)
    assert sorted(nodes.slots.tolist()) == list(range(len(keys)))
    assert (nodes.lookup(keys) == nodes.slots).all()
    other = rng.integers(0, 1 << 63, (1000, 2)).astype(np.uint64) | np.uint64(1 << 63)
    assert (nodes.lookup(other) == -1).all()


def test_equal_digests_are_refused():
    with pytest.raises(ValueError):
        C.NodeTable(np.zeros((2, 2), np.uint64))
