"""Windows by ranges against plain windows, with hot groups, nulls, ties and borders everywhere."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import ranges as R
from strata.operators.windows import rank_within, rolling_rows, row_positions, sort_spec


def rows_of(spark, seed, n=400):
    """Half of the rows in one group; null groups, null and repeated values, NaN and signed zeros."""
    rng = random.Random(seed)
    some = [None, float("nan"), 0.0, -0.0, 1.5]
    rows = [
        ("hot" if i % 2 else rng.choice(["a", "b", None]), rng.choice(some) if rng.random() < 0.2 else rng.random() * 50 - 25, rng.choice(["x", "y", None, f"t{i}"]), i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "g string, v double, t string, id int").repartition(4)


@pytest.mark.parametrize("ranges", [2, 16, 64, 1024])
def test_positions_and_rolling_equal_plain_windows(spark, ranges):
    df = rows_of(spark, ranges)
    w = Window.partitionBy("g").orderBy(sort_spec("v"), sort_spec("id"))
    want = {r.id: r.p for r in df.select("id", F.row_number().over(w).alias("p")).collect()}
    assert {r.id: r.p for r in R.ranged_positions(df, ["g"], ["v", "id"], "p", ranges).collect()} == want
    aggs = {"n": F.count(F.lit(1)), "s": F.sum("id"), "firsts": F.collect_list("id")}
    for preceding in (0, 1, 5):
        plain = rolling_rows(df, ["g"], [sort_spec("v"), sort_spec("id")], aggs, preceding)
        got = R.ranged_rolling(df, ["g"], ["v", "id"], aggs, preceding, ranges)
        assert got.columns == plain.columns
        assert {r.id: (r.n, r.s, r.firsts) for r in got.collect()} == {r.id: (r.n, r.s, r.firsts) for r in plain.collect()}


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("nulls_first", [True, False, None])
def test_rank_over_any_type_equals_plain_rank(spark, monkeypatch, descending, nulls_first):
    monkeypatch.setattr(R, "RANGES", 32)
    df = rows_of(spark, 7)
    w = Window.partitionBy("g").orderBy(sort_spec("v", descending, nulls_first), sort_spec("t"))
    want = {r.id: r.k for r in df.select("id", F.rank().over(w).alias("k")).collect()}
    assert {r.id: r.k for r in rank_within(df, ["g"], "v", ["t"], "k", descending, nulls_first).collect()} == want


def test_no_window_holds_a_hot_group(spark):
    df = spark.range(40_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("g"), (F.hash("id") / 7.0).alias("v"), "id")
    cut = R.with_range(df, ["g"], ["v"], "r", ranges=64)
    held = cut.groupBy("g", "r").count().agg(F.max("count")).first()[0]
    assert held < 20_000 / 32 * 8  # half of 64 ranges lie in the hot group; a range is at most some times the mean
    order = cut.where("g = 0").groupBy("r").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("r").collect()
    assert all(a.hi < b.lo for a, b in zip(order, order[1:]))
    plan = rank_within(df, ["g"], "v", [], "k")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # A window is either of one range or of the totals of ranges.
    assert windows and all("__range" in line for line in windows)


def test_borders_are_a_function_of_the_rows(spark):
    df = rows_of(spark, 3)
    one, other = (R.with_range(x, ["g"], ["v", "id"], "r", ranges=16).select("id", "r") for x in (df, df.repartition(9, "t")))
    assert sorted(one.collect()) == sorted(other.collect())


def test_hard_tables(spark):
    empty = rows_of(spark, 1).limit(0)
    assert R.ranged_positions(empty, ["g"], ["v"], "p").count() == 0
    assert R.ranged_rolling(empty, ["g"], ["v"], {"n": F.count(F.lit(1))}).count() == 0
    same = spark.createDataFrame([("k", 1, {"a": 1})] * 50, "g string, o int, m map<string,int>")
    assert sorted(r.p for r in row_positions(same, ["g"], ["o"], "p").collect()) == list(range(1, 51))
    odd = spark.createDataFrame([(i % 2, i, i) for i in range(9)], "g int, o int, `a.b` int")
    assert {r["a.b"]: r.n for r in R.ranged_rolling(odd, ["g"], ["o"], {"n": F.count(F.lit(1))}, 1, 4).collect()} == {i: 1 if i < 2 else 2 for i in range(9)}


@pytest.mark.parametrize("ranges", [2, 16, 1024])
def test_positions_with_the_size_of_their_group(spark, ranges):
    df = rows_of(spark, ranges + 1)
    w = Window.partitionBy("g").orderBy(sort_spec("v"), sort_spec("id"))
    whole = Window.partitionBy("g")
    want = {r.id: (r.p, r.n) for r in df.select("id", F.row_number().over(w).alias("p"), F.count(F.lit(1)).over(whole).alias("n")).collect()}
    got = R.ranged_positions(df, ["g"], ["v", "id"], "p", ranges, size="n", piece="r")
    rows = got.collect()
    assert {r.id: (r.p, r.n) for r in rows} == want
    # The positions of a piece follow one another.
    pieces = {}
    for r in rows:
        pieces.setdefault((r.g, r.r), []).append(r.p)
    assert all(max(p) - min(p) + 1 == len(p) for p in pieces.values())
