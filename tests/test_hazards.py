"""One test per hazard H1-H14 of the survey."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from conftest import CURRENT, DAILY, DAYS, FIXTURE_RUN, forecast_document, write_doc
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators.quality import collect_checks
from strata.plans import weather as W
from strata.plans.refresh import RAW_TABLE, refresh_all
from strata.sources.envelope import parse_envelope
from strata.sources.raw_documents import read_raw_documents

RUN2 = "source=open_meteo/year=2099/month=01/day=02/run_id=20990102T000000Z"


def raw_of(spark, base):
    good, _ = parse_envelope(read_raw_documents(spark, base), on_error="raise")
    return W.build_raw(good)


def single(spark, tmp_path, doc, city="prague", run=FIXTURE_RUN):
    base = str(tmp_path / "raw")
    write_doc(base, run, city, doc)
    return raw_of(spark, base)


def test_h1_whole_document_per_file(spark, landing):
    docs = read_raw_documents(spark, landing)
    rows = docs.collect()
    assert len(rows) == 5  # pretty-printed JSON spans many lines; still one row per file
    assert all(r.raw_file_path.startswith(FIXTURE_RUN + "/city=") for r in rows)


def test_h2_document_fields_win_over_path(spark, landing):
    raw = raw_of(spark, landing)
    assert {r.source for r in raw.collect()} == {"open-meteo"}
    assert "year" not in raw.columns


def test_h3_ragged_arrays_truncate(spark, tmp_path):
    doc = forecast_document("Prague")
    doc["payload"]["api_response"]["daily"]["temperature_2m_min"] = doc["payload"]["api_response"]["daily"]["temperature_2m_min"][:5]
    daily = W.build_staging_daily(single(spark, tmp_path, doc))
    assert daily.count() == 5


def test_h4_missing_or_null_daily(spark, tmp_path):
    doc = forecast_document("Prague")
    del doc["payload"]["api_response"]["daily"]["precipitation_sum"]
    raw = single(spark, tmp_path, doc)
    assert W.build_staging_daily(raw).count() == 0
    assert W.build_staging_current(raw).count() == 1
    doc2 = forecast_document("Vienna")
    doc2["payload"]["api_response"]["daily"]["time"] = None
    assert W.build_staging_daily(single(spark, tmp_path / "b", doc2, "vienna")).count() == 0


def test_h4_null_element_is_null_value(spark, tmp_path):
    doc = forecast_document("Prague")
    doc["payload"]["api_response"]["daily"]["precipitation_sum"][2] = None
    rows = {r.forecast_date: r for r in W.build_staging_daily(single(spark, tmp_path, doc)).collect()}
    assert rows[dt.date(2026, 3, 15)].precipitation_mm is None
    assert rows[dt.date(2026, 3, 14)].precipitation_mm == Decimal("0.00")


def test_h4_missing_current_time_skips_current_row(spark, tmp_path):
    doc = forecast_document("Prague")
    del doc["payload"]["api_response"]["current"]["time"]
    raw = single(spark, tmp_path, doc)
    assert W.build_staging_current(raw).count() == 0
    assert W.build_staging_daily(raw).count() == 7


def test_h5_null_max_ranks_first(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2026, 1, 1), Decimal("5.00")), ("b", dt.date(2026, 1, 1), None), ("c", dt.date(2026, 1, 1), Decimal("9.00"))],
        "city string, forecast_date date, temperature_max_c decimal(6,2)",
    ).withColumn("temperature_avg_c", F.lit(None).cast("decimal(6,2)")).withColumn("precipitation_mm", F.lit(None).cast("decimal(8,2)"))
    ranks = {r.city: r.max_temperature_rank for r in W.build_rankings(df).collect()}
    assert ranks == {"b": 1, "c": 2, "a": 3}


def test_h6_rolling_average_rounds_half_up(spark):
    rows = [("x", dt.date(2026, 1, d), Decimal(v), Decimal("0.00")) for d, v in [(1, "0.01"), (2, "0.02"), (3, "0.02"), (4, "0.03")]]
    df = spark.createDataFrame(rows, "city string, forecast_date date, temperature_avg_c decimal(6,2), precipitation_mm decimal(8,2)")
    got = [r.rolling_3day_avg_temp_c for r in W.rolling_metrics(df).orderBy("forecast_date").collect()]
    # 0.01, avg(0.01,0.02)=0.015 -> 0.02, avg(.01,.02,.02)=0.01667 -> 0.02, avg(.02,.02,.03)=0.02333 -> 0.02
    assert got == [Decimal("0.01"), Decimal("0.02"), Decimal("0.02"), Decimal("0.02")]


def test_h6_rolling_frame_counts_rows_not_days(spark):
    rows = [("x", dt.date(2026, 1, d), Decimal(v), Decimal(p)) for d, v, p in [(1, "1.00", "1.00"), (5, "2.00", "2.00"), (9, "6.00", "4.00")]]
    df = spark.createDataFrame(rows, "city string, forecast_date date, temperature_avg_c decimal(6,2), precipitation_mm decimal(8,2)")
    last = W.rolling_metrics(df).orderBy("forecast_date").collect()[-1]
    assert last.rolling_3day_avg_temp_c == Decimal("3.00") and last.rolling_3day_precip_mm == Decimal("7.00")


def test_h7_offset_without_seconds_rejected_by_strict_cast(spark, tmp_path):
    doc = forecast_document("Prague")
    doc["payload"]["api_response"]["current"]["time"] = "2026-03-13T14:45+02:00"
    with pytest.raises(PySparkException):
        W.build_staging_current(single(spark, tmp_path, doc)).collect()


def test_h8_duplicate_date_keeps_first_position(spark, tmp_path):
    doc = forecast_document("Prague")
    d = doc["payload"]["api_response"]["daily"]
    d["time"][1] = d["time"][0]
    rows = W.build_staging_daily(single(spark, tmp_path, doc)).collect()
    first = [r for r in rows if r.forecast_date == dt.date(2026, 3, 13)]
    assert len(rows) == 6 and len(first) == 1
    assert first[0].temperature_max_c == Decimal("15.90")


def test_h9_deterministic_ids_and_tiebreak(spark, tmp_path):
    base = str(tmp_path / "raw")
    write_doc(base, FIXTURE_RUN, "prague", forecast_document("Prague"))
    hot = forecast_document("Prague", daily=([30.0] * 7, [1.0] * 7, [0.0] * 7))
    write_doc(base, FIXTURE_RUN, "prague_2", hot)  # same city, same ingestion time
    raw = raw_of(spark, base)
    ids1 = sorted(r.raw_record_id for r in raw.collect())
    ids2 = sorted(r.raw_record_id for r in raw_of(spark, base).collect())
    assert ids1 == ids2
    summary = W.build_daily_summary(W.build_staging_daily(raw)).collect()
    assert len(summary) == 7
    # later path wins the tie: .../city=prague_2.json > .../city=prague.json
    assert {r.temperature_max_c for r in summary} == {Decimal("30.00")}


def test_h10_idempotent_rerun(spark, landing, tmp_path):
    wh = str(tmp_path / "wh")
    first = refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 2))
    assert first["raw"]["inserted"] == 5
    snap1 = sorted(map(tuple, first["marts"]["daily_city_weather_summary"].drop("refreshed_at_utc").collect()))
    second = refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 3))
    assert second["raw"] == {"inserted": 0, "skipped": 5, "total": 5}
    assert spark.read.parquet(f"{wh}/{RAW_TABLE}").count() == 5
    assert spark.read.parquet(f"{wh}/staging/weather_daily_forecast").count() == 35
    snap2 = sorted(map(tuple, second["marts"]["daily_city_weather_summary"].drop("refreshed_at_utc").collect()))
    assert snap1 == snap2
    assert all(r.passed for r in second["checks"].collect())


def test_h11_null_precipitation_fails_strict_refresh(spark, tmp_path):
    base = str(tmp_path / "raw")
    doc = forecast_document("Prague")
    doc["payload"]["api_response"]["daily"]["precipitation_sum"][0] = None
    write_doc(base, FIXTURE_RUN, "prague", doc)
    with pytest.raises(PySparkException, match="NOT NULL violated"):
        refresh_all(spark, base, str(tmp_path / "wh"), city_count=1, run_at=dt.datetime(2099, 1, 2))
    lenient = refresh_all(spark, base, str(tmp_path / "wh2"), city_count=1, run_at=dt.datetime(2099, 1, 2), strict=False)
    checks = {r.name: r.issue_count for r in lenient["checks"].collect()}
    assert checks["mart_daily_summary_nulls"] == 1


def test_h12_newer_snapshot_drops_older_dates(spark, tmp_path):
    base = str(tmp_path / "raw")
    write_doc(base, FIXTURE_RUN, "prague", forecast_document("Prague"))
    newer_days = DAYS[2:] + ["2026-03-20", "2026-03-21"]
    write_doc(base, RUN2, "prague", forecast_document("Prague", ingested="2099-01-02T00:00:00Z", days=newer_days))
    raw = raw_of(spark, base)
    summary = W.build_daily_summary(W.build_staging_daily(raw)).collect()
    assert sorted(r.forecast_date.isoformat() for r in summary) == sorted(newer_days)
    assert {r.source_ingested_at_utc for r in summary} == {dt.datetime(2099, 1, 2)}


def test_h13_dropped_city_still_counted(spark, landing):
    raw = raw_of(spark, landing)
    summary = W.build_daily_summary(W.build_staging_daily(raw))
    marts = {
        "city_current_weather": W.build_mart_current(W.build_staging_current(raw)),
        "daily_city_weather_summary": summary,
        "daily_temperature_rankings": W.build_rankings(summary),
        "city_rolling_3day_metrics": W.build_rolling(summary),
    }
    checks = {r.name: r.issue_count for r in collect_checks(marts, city_count=4).collect()}
    assert checks["mart_current_weather_row_count"] == 1
    assert checks["mart_daily_summary_row_count"] == 1


def test_h14_city_case_is_kept(spark, tmp_path):
    base = str(tmp_path / "raw")
    write_doc(base, FIXTURE_RUN, "prague", forecast_document("Prague"))
    write_doc(base, RUN2, "prague", forecast_document("PRAGUE", ingested="2099-01-02T00:00:00Z", daily=DAILY["Prague"], current=CURRENT["Prague"]))
    cur = W.build_mart_current(W.build_staging_current(raw_of(spark, base)))
    assert sorted(r.city for r in cur.collect()) == ["PRAGUE", "Prague"]


def test_h1_fixture_documents_are_pretty_printed():
    doc = json.dumps(forecast_document("Prague"), indent=2)
    assert doc.count("\n") > 10 and set(DAILY) >= {"Prague"}


def test_h4_malformed_daily_arrays_are_reported(spark, tmp_path):
    base = str(tmp_path / "raw")
    ok = forecast_document("Prague")
    null_arr = forecast_document("Vienna")
    null_arr["payload"]["api_response"]["daily"]["time"] = None
    scalar = forecast_document("Berlin")
    scalar["payload"]["api_response"]["daily"]["precipitation_sum"] = 3.5
    missing = forecast_document("Warsaw")
    del missing["payload"]["api_response"]["daily"]["temperature_2m_max"]
    for city, doc in [("prague", ok), ("vienna", null_arr), ("berlin", scalar), ("warsaw", missing)]:
        write_doc(base, FIXTURE_RUN, city, doc)
    raw = raw_of(spark, base)
    rejects = sorted((r.raw_file_path.split("city=")[1], r.field, r.reason) for r in W.daily_array_rejects(raw).collect())
    assert rejects == [
        ("berlin.json", "precipitation_sum", "not an array"),
        ("vienna.json", "time", "JSON null instead of an array"),
    ]
    assert W.build_staging_daily(raw).select("city").distinct().count() == 1


def test_h4_strict_refresh_refuses_malformed_arrays(spark, tmp_path):
    base = str(tmp_path / "raw")
    doc = forecast_document("Prague")
    doc["payload"]["api_response"]["daily"]["time"] = "2026-03-13"
    write_doc(base, FIXTURE_RUN, "prague", doc)
    with pytest.raises(ValueError, match="Malformed daily arrays"):
        refresh_all(spark, base, str(tmp_path / "wh"), city_count=1, run_at=dt.datetime(2099, 1, 2))
    res = refresh_all(spark, base, str(tmp_path / "wh2"), city_count=1, run_at=dt.datetime(2099, 1, 2), strict=False)
    assert res["marts"]["city_current_weather"].count() == 1
    assert res["marts"]["daily_city_weather_summary"].count() == 0
