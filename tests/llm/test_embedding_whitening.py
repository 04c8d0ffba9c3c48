import math
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import types as T

from strata.llm import embedding_whitening as E
from strata.llm.queries import op11_embedding_whitening

SCHEMA = T.StructType([
    T.StructField("n", T.StringType()),
    T.StructField("vec_id", T.LongType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("v", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
])


def table(spark, rows):
    return spark.createDataFrame([("a", i, v, 1, 2) for i, v in rows], SCHEMA).repartition(3)


def brute_force(rows, components=16):
    """Exact sums by fractions, then a dense eigensolver."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    d = max(set(sizes), key=lambda k: (sizes.count(k), k), default=0)
    xs = [(i, tuple(math.floor(64 * c) + 1000000 for c in np.array(v, np.float32).astype(float).tolist())) for i, v in kept if len(v) == d]
    fit = sorted({x for _, x in xs})
    n = len(fit)
    if n < 2:
        return n, [], None
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    out = []
    for i, x in xs:
        y = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        out.append((i, sum((n * a - s) ** 2 for a, s in zip(x, sums)), (y @ vectors[:, :k]) / np.sqrt(values[:k])))
    return n, out, values[:k] / values.sum()


def compare(got, rows):
    n, expected, explained = brute_force(rows)
    assert len(got) == sum(len(w) for _, _, w in expected)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert all(r["n"] == n for r in got)
    sign = {}
    for i, deviation, w in expected:
        for k, e in enumerate(w, 1):
            found = [r for r in by_id[i] if r["component"] == k]
            assert all(r["deviation"] == deviation for r in found)
            assert all(abs(r["explained"] / explained[k - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in found)
            if abs(e) > 1e-3:
                sign.setdefault(k, math.copysign(1, e * found[0]["whitened"]))
            assert all(abs(r["whitened"] * sign.get(k, 1) - e) < 1e-6 for r in found)


def test_given_table_and_hard_rows(spark):
    given = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    width = len(given[0][1])
    hard = [
        (-1, None), (-2, []), (-3, [1.0] * (width - 1) + [None]), (-4, [math.nan] * width), (-5, [math.inf] + [0.0] * (width - 1)), (-6, [0.5, 0.25]),
        (-7, given[0][1]), (-8, given[0][1]), (-9, [1e-3 * i - 7 for i in range(width)]),
    ]
    compare(E.whiten(table(spark, given + hard)).collect(), given + hard)


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = op11_embedding_whitening(spark, SF_SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), rows)


def test_few_distinct_vectors_give_few_components(spark):
    rows = [(i, [[1.0, 2.0, 3.0], [1.5, 2.0, -3.0], [0.0, 9.0, 3.0]][i % 3]) for i in range(30)]
    got = E.whiten(table(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {3}
    compare(got, rows)


def test_rows_without_variance_nulls_and_empty(spark):
    assert E.whiten(table(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    assert E.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert E.whiten(table(spark, [])).count() == 0
    got = E.whiten(table(spark, [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [3.0, 1.0])])).collect()
    assert sorted(str(r["vec_id"]) for r in got) == ["4", "None", "None"]


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i) * 2.0**40, 1.0, -float(i * i)]) for i in range(40)]
    n, expected, _ = brute_force(rows)
    got = {r["vec_id"]: r["deviation"] for r in E.whiten(table(spark, rows)).collect()}
    assert got == {i: d if d < 2**63 else None for i, d, _ in expected}


@pytest.mark.parametrize("rank", [1, 5, 12])
def test_factor_and_rotation(rank):
    rng = np.random.default_rng(rank)
    a = rng.normal(size=(200, rank)) @ (rng.normal(size=(rank, 12)) * np.logspace(0, -5, 12))
    c = a.T @ a
    factor = E.pivoted_cholesky(c)
    assert factor.shape == (12, rank) and np.allclose(factor @ factor.T, c, atol=1e-12 * np.trace(c))
    values, vectors = E.one_sided_jacobi(factor)
    assert (np.diff(values) <= 0).all() and np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
    assert np.allclose(np.linalg.eigvalsh(c)[::-1][:rank], values, atol=1e-12 * values[0])
    assert np.allclose((vectors * values) @ vectors.T, c, atol=1e-12 * values[0])


def test_rounds_hold_every_pair_once():
    for n in (1, 2, 5, 8):
        pairs = [(int(a), int(b)) for p, q in E._rounds(n) for a, b in zip(p, q)]
        assert sorted(pairs) == [(a, b) for a in range(n) for b in range(a + 1, n)]
        assert all(len(set(p) | set(q)) == 2 * len(p) for p, q in E._rounds(n))
