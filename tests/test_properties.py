"""Property tests: operators against plain-Python brute force on random data."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.arrays import explode_aligned
from strata.operators.windows import latest_snapshot, sort_spec
from strata.plans import weather as W

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))

maybe_int = st.one_of(st.none(), st.integers(-5, 5))
arrays = st.one_of(st.none(), st.lists(maybe_int, max_size=6))


@SETTINGS
@given(st.lists(st.tuples(arrays, arrays, arrays), min_size=1, max_size=25))
def test_explode_aligned_matches_brute_force(spark, docs):
    rows = [(i, a, b, c) for i, (a, b, c) in enumerate(docs)]
    df = spark.createDataFrame(rows, "id int, a array<int>, b array<int>, c array<int>")
    got = sorted(
        (r.id, r.pos, r.x, r.y, r.z)
        for r in explode_aligned(df, {"x": F.col("a"), "y": F.col("b"), "z": F.col("c")}, keep=["id"], position="pos").collect()
    )
    want = []
    for i, a, b, c in rows:
        if a is None or b is None or c is None:
            continue
        for p in range(min(len(a), len(b), len(c))):
            want.append((i, p + 1, a[p], b[p], c[p]))
    assert got == sorted(want)


def half_up(x: Decimal) -> Decimal:
    return x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


snap_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),            # city
        st.integers(1, 6),                            # forecast day
        st.integers(0, 3),                            # snapshot (ingestion day)
        st.integers(0, 2),                            # load order
        st.integers(-500, 3000),                      # max, in cents
        st.integers(-500, 3000),                      # min, in cents
        st.one_of(st.none(), st.integers(0, 900)),    # precipitation, in cents
    ),
    min_size=1,
    max_size=40,
)


@SETTINGS
@given(snap_rows)
def test_daily_summary_and_rolling_match_brute_force(spark, rows):
    base = dt.datetime(2099, 1, 1)
    data = [
        (i, city, dt.date(2026, 3, day), Decimal(mx) / 100, Decimal(mn) / 100, None if pr is None else Decimal(pr) / 100,
         base + dt.timedelta(days=snap), base + dt.timedelta(hours=load), f"p{i:03d}")
        for i, (city, day, snap, load, mx, mn, pr) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data,
        "raw_record_id long, city string, forecast_date date, temperature_max_c decimal(6,2), temperature_min_c decimal(6,2), "
        "precipitation_mm decimal(8,2), source_ingested_at_utc timestamp, raw_loaded_at_utc timestamp, raw_file_path string",
    )
    summary = W.build_daily_summary(df)
    got = {(r.city, r.forecast_date): r for r in summary.collect()}

    # brute force: newest snapshot per city, then per date the newest (load, path)
    want = {}
    for city in {d[1] for d in data}:
        mine = [d for d in data if d[1] == city]
        newest = max(d[6] for d in mine)
        for d in sorted((d for d in mine if d[6] == newest), key=lambda d: (d[7], d[8])):
            want[(city, d[2])] = d  # later (load, path) overwrites
    assert set(got) == set(want)
    for key, d in want.items():
        r = got[key]
        assert (r.temperature_max_c, r.temperature_min_c, r.precipitation_mm) == (d[3], d[4], d[5])
        assert r.temperature_avg_c == half_up((d[3] + d[4]) / 2)
        assert r.is_wet_day == (None if d[5] is None else d[5] > 0)

    rolled = {(r.city, r.forecast_date): r for r in W.rolling_metrics(summary).collect()}
    for city in {k[0] for k in want}:
        days = sorted(k[1] for k in want if k[0] == city)
        for i, day in enumerate(days):
            frame = [got[(city, x)] for x in days[max(0, i - 2): i + 1]]
            avgs = [f.temperature_avg_c for f in frame]
            precs = [f.precipitation_mm for f in frame if f.precipitation_mm is not None]
            r = rolled[(city, day)]
            assert r.rolling_3day_avg_temp_c == half_up(sum(avgs) / len(avgs))
            assert r.rolling_3day_precip_mm == (sum(precs) if precs else None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=40))
def test_latest_snapshot_plain_keys(spark, rows):
    df = spark.createDataFrame([(k, s, v, i) for i, (k, s, v) in enumerate(rows)], "k int, s int, v int, id int")
    got = sorted((r.k, r.d, r.id) for r in latest_snapshot(
        df.withColumn("d", F.col("v") % 3), ["k"], "s", ["d"], [sort_spec("id", True)]
    ).collect())
    want = {}
    for i, (k, s, v) in enumerate(rows):
        newest = max(s2 for k2, s2, _ in rows if k2 == k)
        if s == newest:
            key = (k, v % 3)
            want[key] = max(want.get(key, -1), i)
    assert got == sorted((k, d, i) for (k, d), i in want.items())
