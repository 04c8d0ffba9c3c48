"""The five fixture documents reproduce the golden marts of FIXTURES.md exactly."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import DAYS, dec

from strata.operators.quality import collect_checks
from strata.plans import weather as W
from strata.sources.envelope import parse_envelope
from strata.sources.raw_documents import read_raw_documents

# city: list of (max, min, avg, range, precip, wet, rank, roll_avg, roll_precip) per day
GOLDEN = {
    "Berlin": [
        (16.60, 5.10, 10.85, 11.50, 0.00, False, 3, 10.85, 0.00), (12.70, 6.60, 9.65, 6.10, 2.90, True, 5, 10.25, 2.90),
        (8.70, 3.50, 6.10, 5.20, 0.03, True, 4, 8.87, 2.93), (8.30, 1.50, 4.90, 6.80, 2.50, True, 5, 6.88, 5.43),
        (12.00, 0.80, 6.40, 11.20, 0.00, False, 2, 5.80, 2.53), (13.70, 1.70, 7.70, 12.00, 0.00, False, 1, 6.33, 2.50),
        (15.70, 3.30, 9.50, 12.40, 0.00, False, 1, 7.87, 0.00),
    ],
    "Budapest": [
        (18.30, 9.20, 13.75, 9.10, 0.00, False, 1, 13.75, 0.00), (17.00, 7.40, 12.20, 9.60, 0.00, False, 2, 12.98, 0.00),
        (16.60, 6.70, 11.65, 9.90, 0.00, False, 1, 12.53, 0.00), (16.50, 3.80, 10.15, 12.70, 0.00, False, 1, 11.33, 0.00),
        (13.50, 5.50, 9.50, 8.00, 0.00, False, 1, 10.43, 0.00), (10.10, 5.70, 7.90, 4.40, 2.10, True, 5, 9.18, 2.10),
        (15.00, 5.50, 10.25, 9.50, 0.00, False, 2, 9.22, 2.10),
    ],
    "Prague": [
        (15.90, 2.50, 9.20, 13.40, 0.00, False, 4, 9.20, 0.00), (14.00, 7.00, 10.50, 7.00, 0.00, False, 4, 9.85, 0.00),
        (8.50, 5.40, 6.95, 3.10, 5.40, True, 5, 8.88, 5.40), (9.90, 3.40, 6.65, 6.50, 0.40, True, 4, 8.03, 5.80),
        (10.00, 2.30, 6.15, 7.70, 0.30, True, 4, 6.58, 6.10), (13.00, 0.90, 6.95, 12.10, 0.00, False, 2, 6.58, 0.70),
        (13.70, 2.60, 8.15, 11.10, 0.00, False, 3, 7.08, 0.30),
    ],
    "Vienna": [
        (18.10, 5.40, 11.75, 12.70, 0.00, False, 2, 11.75, 0.00), (18.30, 7.30, 12.80, 11.00, 0.00, False, 1, 12.28, 0.00),
        (13.60, 7.00, 10.30, 6.60, 0.00, False, 3, 11.62, 0.00), (12.10, 7.20, 9.65, 4.90, 0.50, True, 2, 10.92, 0.50),
        (10.30, 5.10, 7.70, 5.20, 1.00, True, 3, 9.22, 1.50), (13.00, 4.10, 8.55, 8.90, 0.00, False, 3, 8.63, 1.50),
        (11.90, 5.40, 8.65, 6.50, 0.00, False, 5, 8.30, 1.00),
    ],
    "Warsaw": [
        (15.80, 5.30, 10.55, 10.50, 0.00, False, 5, 10.55, 0.00), (15.80, 4.30, 10.05, 11.50, 0.00, False, 3, 10.30, 0.00),
        (15.40, 3.10, 9.25, 12.30, 12.42, True, 2, 9.95, 12.42), (10.10, 3.00, 6.55, 7.10, 18.60, True, 3, 8.62, 31.02),
        (9.40, -0.20, 4.60, 9.60, 0.00, False, 5, 6.80, 31.02), (10.60, 0.20, 5.40, 10.40, 0.00, False, 4, 5.52, 18.60),
        (12.50, 1.00, 6.75, 11.50, 0.00, False, 4, 5.58, 0.00),
    ],
}
GOLDEN_CURRENT = {
    "Berlin": (16.60, 38.00, 20.90), "Budapest": (18.10, 40.00, 13.00), "Prague": (15.90, 38.00, 14.10),
    "Vienna": (17.80, 35.00, 18.30), "Warsaw": (15.70, 67.00, 12.20),
}


def build(spark, landing):
    good, rejects = parse_envelope(read_raw_documents(spark, landing), on_error="reject")
    assert rejects.count() == 0
    raw = W.build_raw(good)
    cur, daily = W.build_staging_current(raw), W.build_staging_daily(raw)
    summary = W.build_daily_summary(daily)
    return {
        "city_current_weather": W.build_mart_current(cur),
        "daily_city_weather_summary": summary,
        "daily_temperature_rankings": W.build_rankings(summary),
        "city_rolling_3day_metrics": W.build_rolling(summary),
    }


def test_golden_daily_marts(spark, landing):
    marts = build(spark, landing)
    summary = {(r.city, r.forecast_date): r for r in marts["daily_city_weather_summary"].collect()}
    ranks = {(r.city, r.forecast_date): r for r in marts["daily_temperature_rankings"].collect()}
    rolling = {(r.city, r.forecast_date): r for r in marts["city_rolling_3day_metrics"].collect()}
    assert len(summary) == len(ranks) == len(rolling) == 35
    for city, rows in GOLDEN.items():
        for day, g in zip(DAYS, rows):
            key = (city, dt.date.fromisoformat(day))
            s, k, r = summary[key], ranks[key], rolling[key]
            assert (s.temperature_max_c, s.temperature_min_c, s.temperature_avg_c, s.diurnal_temp_range_c, s.precipitation_mm) == tuple(dec(x) for x in g[:5])
            assert s.is_wet_day is g[5]
            assert k.max_temperature_rank == g[6]
            assert (r.rolling_3day_avg_temp_c, r.rolling_3day_precip_mm) == (dec(g[7]), dec(g[8]))
            assert s.source_ingested_at_utc == dt.datetime(2099, 1, 1)


def test_golden_current_and_checks(spark, landing):
    marts = build(spark, landing)
    cur = {r.city: r for r in marts["city_current_weather"].collect()}
    assert set(cur) == set(GOLDEN_CURRENT)
    for city, (t, h, w) in GOLDEN_CURRENT.items():
        r = cur[city]
        assert (r.temperature_c, r.relative_humidity_pct, r.wind_speed_kmh) == (dec(t), dec(h), dec(w))
        assert r.current_time_utc == dt.datetime(2026, 3, 13, 14, 45)
    checks = collect_checks(marts, city_count=5, forecast_days=7).orderBy("check_order").collect()
    assert len(checks) == 9
    assert all(c.passed and c.issue_count == 0 for c in checks), checks


def test_decimal_types(spark, landing):
    marts = build(spark, landing)
    types = dict(marts["daily_city_weather_summary"].dtypes)
    assert types["temperature_max_c"] == "decimal(6,2)"
    assert types["temperature_avg_c"] == "decimal(6,2)"
    assert types["precipitation_mm"] == "decimal(8,2)"
    assert dict(marts["daily_temperature_rankings"].dtypes)["max_temperature_rank"] == "bigint"
    assert isinstance(marts["city_rolling_3day_metrics"].first().rolling_3day_avg_temp_c, Decimal)
