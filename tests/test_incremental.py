"""Incremental mart maintenance equals a full rebuild from all of staging."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import CURRENT, DAILY, DAYS, FIXTURE_RUN, forecast_document, write_doc
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators.quality import collect_checks
from strata.plans.refresh import (
    LOAD,
    MART_DIR,
    MART_NAMES,
    RAW_LOG,
    RAW_TABLE,
    REJECTS,
    STAGED_LOG,
    STG_CURRENT,
    STG_DAILY,
    check_primary_keys,
    known_paths,
    load_raw,
    load_staging,
    pending_loads,
    published_marts,
    raw_rows,
    read_table,
    refresh_all,
    unpublished_loads,
)
from strata.sources.commits import read_log
from strata.sources.raw_documents import read_raw_documents, write_raw_documents
from strata.sources.snapshot import head

RUNS = [
    # run 1: the five fixture cities
    [(FIXTURE_RUN, c.lower(), forecast_document(c)) for c in DAILY],
    # run 2: a newer Prague snapshot with shifted days, and a second Vienna
    # document with the same ingestion time as run 1 (a tie on snapshot time)
    [
        ("source=open_meteo/year=2099/month=01/day=02/run_id=20990102T000000Z", "prague",
         forecast_document("Prague", ingested="2099-01-02T00:00:00Z", days=DAYS[2:] + ["2026-03-20", "2026-03-21"])),
        ("source=open_meteo/year=2099/month=01/day=01/run_id=20990101T000001Z", "vienna",
         forecast_document("Vienna", daily=([20.0] * 7, [2.0] * 7, [1.0] * 7), current=(1.0, 2, 3.0))),
    ],
    # run 3: a late, older Berlin run that must not win
    [("source=open_meteo/year=2098/month=12/day=31/run_id=20981231T000000Z", "berlin",
      forecast_document("Berlin", ingested="2098-12-31T00:00:00Z", daily=([1.0] * 7, [0.0] * 7, [9.0] * 7), current=CURRENT["Berlin"]))],
]


def snapshot(marts):
    return {n: sorted(map(tuple, marts[n].drop("refreshed_at_utc").collect())) for n in MART_NAMES}


def test_incremental_equals_rebuild(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for i, run in enumerate(RUNS):
        for rel, city, doc in run:
            write_doc(landing, rel, city, doc)
        at = dt.datetime(2099, 2, 1 + i)
        inc = refresh_all(spark, landing, str(tmp_path / "inc"), city_count=5, run_at=at)
        full = refresh_all(spark, landing, str(tmp_path / f"full{i}"), city_count=5, run_at=at, rebuild=True)
        assert snapshot(inc["marts"]) == snapshot(full["marts"]), f"run {i + 1}"
    final = snapshot(inc["marts"])
    prague = [r for r in final["daily_city_weather_summary"] if r[0] == "Prague"]
    assert len(prague) == 7 and prague[-1][1] == dt.date(2026, 3, 21)
    vienna = {r[1]: r for r in final["daily_city_weather_summary"] if r[0] == "Vienna"}
    assert float(vienna[dt.date(2026, 3, 13)][2]) == 20.0  # the later load wins the tie
    berlin = {r[1]: r for r in final["daily_city_weather_summary"] if r[0] == "Berlin"}
    assert float(berlin[dt.date(2026, 3, 13)][2]) == 16.6  # the late older run does not
    assert pending_loads(spark, str(tmp_path / "inc")) == unpublished_loads(spark, str(tmp_path / "inc")) == []
    assert len(read_log(spark, str(tmp_path / "inc" / STAGED_LOG))) == 3


def test_crash_before_staging_is_recovered(spark, tmp_path, landing):
    wh = str(tmp_path / "wh")
    assert load_raw(spark, landing, wh, dt.datetime(2099, 1, 5))["inserted"] == 5  # "crash" here
    assert len(pending_loads(spark, wh)) == 1
    res = refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 6))
    assert res["raw"]["inserted"] == 0
    assert res["marts"]["daily_city_weather_summary"].count() == 35
    assert all(r.passed for r in res["checks"].collect())


def test_crash_after_staging_is_recovered(spark, tmp_path, landing):
    wh = str(tmp_path / "wh")
    load_raw(spark, landing, wh, dt.datetime(2099, 1, 5))
    load_staging(spark, wh, "2099-01-05 00:00:00")  # "crash" here
    assert pending_loads(spark, wh) == [] and len(unpublished_loads(spark, wh)) == 1
    res = refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 6))
    assert res["marts"]["daily_city_weather_summary"].count() == 35
    assert unpublished_loads(spark, wh) == []


def test_crash_between_two_staging_tables_stages_nothing_twice(spark, tmp_path, landing, monkeypatch):
    wh = str(tmp_path / "wh")
    load_raw(spark, landing, wh, dt.datetime(2099, 1, 5))
    monkeypatch.setattr("strata.plans.weather.daily_rows", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    monkeypatch.setattr("strata.plans.refresh.delete", lambda *a: None)  # a crash cleans nothing up
    with pytest.raises(OSError):
        load_staging(spark, wh, "2099-01-05 00:00:00")
    monkeypatch.undo()
    res = refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 6))
    assert read_table(spark, wh, STG_CURRENT).count() == 5 and read_table(spark, wh, STG_DAILY).count() == 35
    assert res["marts"]["city_current_weather"].count() == 5


DAY2 = "source=open_meteo/year=2099/month=01/day=02/run_id=20990102T000000Z"


def test_failed_publish_is_raised_again_until_newer_data_mends_it(spark, tmp_path, landing):
    wh = str(tmp_path / "wh")
    refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 2, 1))
    bad = forecast_document("Prague", ingested="2099-01-02T00:00:00Z")
    bad["payload"]["api_response"]["daily"]["precipitation_sum"][3] = None
    write_doc(landing, DAY2, "prague", bad)
    write_doc(landing, DAY2, "vienna", forecast_document("Vienna", ingested="2099-01-02T00:00:00Z", daily=([33.0] * 7, [3.0] * 7, [1.0] * 7)))
    for day in (2, 3, 4):  # nothing new lands, but the error does not go away
        with pytest.raises(PySparkException, match="NOT NULL violated"):
            refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 2, day))
    assert len(unpublished_loads(spark, wh)) == 1
    write_doc(landing, "source=open_meteo/year=2099/month=01/day=03/run_id=20990103T000000Z", "prague", forecast_document("Prague", ingested="2099-01-03T00:00:00Z"))
    done = refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 2, 5))
    full = refresh_all(spark, landing, str(tmp_path / "full"), city_count=5, run_at=dt.datetime(2099, 2, 5), rebuild=True)
    assert snapshot(done["marts"]) == snapshot(full["marts"])
    vienna = done["marts"]["daily_city_weather_summary"].where("city = 'Vienna'").first()
    assert float(vienna.temperature_max_c) == 33.0
    assert unpublished_loads(spark, wh) == []


def test_two_loads_of_one_time_lose_nothing(spark, tmp_path, landing):
    wh, at = str(tmp_path / "wh"), dt.datetime(2099, 2, 1)
    refresh_all(spark, landing, wh, city_count=5, run_at=at)
    write_doc(landing, DAY2, "oslo", forecast_document("Prague") | {"city": "Oslo"})
    res = refresh_all(spark, landing, wh, city_count=6, run_at=at)
    assert res["raw"] == {"inserted": 1, "skipped": 5, "total": 6}
    assert res["marts"]["city_current_weather"].count() == 6
    assert read_table(spark, wh, RAW_TABLE).select(LOAD).distinct().count() == 2


def test_a_document_that_breaks_the_raw_contract_changes_nothing(spark, tmp_path, landing):
    wh = str(tmp_path / "wh")
    write_doc(landing, DAY2, "nowhere", forecast_document("Prague") | {"city": None})
    with pytest.raises(PySparkException, match="null keys city"):
        refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 2, 1))
    assert read_table(spark, wh, RAW_TABLE).count() == 0


def test_null_date_is_refused_or_kept_as_a_reject(spark, tmp_path):
    base = str(tmp_path / "raw")
    doc = forecast_document("Prague")
    doc["payload"]["api_response"]["daily"]["time"][2] = None
    write_doc(base, FIXTURE_RUN, "prague", doc)
    with pytest.raises(PySparkException, match="NOT NULL violated: staging/weather_daily_forecast.forecast_date"):
        refresh_all(spark, base, str(tmp_path / "wh"), city_count=1, run_at=dt.datetime(2099, 1, 2))
    res = refresh_all(spark, base, str(tmp_path / "wh2"), city_count=1, run_at=dt.datetime(2099, 1, 2), strict=False)
    assert res["marts"]["daily_city_weather_summary"].count() == 6
    rejects = spark.read.parquet(str(tmp_path / "wh2" / REJECTS)).collect()
    assert [(r.field, r.reason) for r in rejects] == [("forecast_date", "NULL in staging/weather_daily_forecast")]


def test_marts_refuse_a_key_that_occurs_twice(spark):
    rows = spark.createDataFrame([("Prague", "2099-01-01"), ("Prague", "2099-01-01")], "city string, forecast_date string")
    with pytest.raises(ValueError, match="PRIMARY KEY violated: 1 values of city, forecast_date"):
        check_primary_keys({"daily_city_weather_summary": rows})
    check_primary_keys({"daily_city_weather_summary": rows.distinct(), "_state_daily": rows})


def test_known_days_are_not_read_again(spark, landing, tmp_path, monkeypatch):
    wh, read = str(tmp_path / "wh"), []
    monkeypatch.setattr("strata.plans.refresh.read_raw_documents", lambda s, b, d, days: read.append(days) or read_raw_documents(s, b, d, days))
    refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 2))
    write_doc(landing, DAY2, "prague", forecast_document("Prague", ingested="2099-01-02T00:00:00Z"))
    refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 3))
    refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 4))
    assert read == [[("2099", "01", "01")], [("2099", "01", "02")]]
    files = read_raw_documents(spark, landing, days=[("2099", "01", "02")]).inputFiles()
    assert len(files) == 1 and "day=02" in files[0]


def test_packed_landing_replaces_a_document_and_prunes_days(spark, tmp_path):
    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    for k, hot in enumerate((20.0, 30.0)):
        rows = [(json.dumps(forecast_document(c, daily=([hot] * 7, [1.0] * 7, [0.0] * 7))), f"{FIXTURE_RUN}/city={c.lower()}.json", "2099", "01", "01") for c in ("Prague", "Berlin")]
        docs = spark.createDataFrame(rows, "value string, raw_file_path string, year string, month string, day string")
        write_raw_documents(docs, base, landed_at=F.lit(f"2099-01-01 0{k}:00:00").cast("timestamp"))
    res = refresh_all(spark, base, wh, city_count=2, run_at=dt.datetime(2099, 1, 2))
    assert res["raw"] == {"inserted": 2, "skipped": 2, "total": 4}
    assert {float(r.temperature_max_c) for r in res["marts"]["daily_city_weather_summary"].collect()} == {30.0}
    plan = read_raw_documents(spark, base, days=[("2099", "01", "02")])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "concat_ws(-, year" in plan


def test_pending_load_read_prunes_partitions(spark, landing, tmp_path):
    wh = str(tmp_path / "wh")
    refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 1, 2))
    df = raw_rows(spark, wh, ["another load"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_id" in plan
    assert df.count() == 0


# ---------------------------------------------------------------- runs that meet

def land(base, day, city, **more):
    rel = f"source=open_meteo/year=2099/month=01/day={day:02d}/run_id=209901{day:02d}T000000Z"
    write_doc(base, rel, city.lower().replace(" ", "_"), forecast_document("Prague", ingested=f"2099-01-{day:02d}T00:00:00Z", **more) | {"city": city})


def test_interleaved_refreshes_equal_a_rebuild(spark, tmp_path):
    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    land(base, 1, "Prague")
    refresh_all(spark, base, wh, city_count=1, run_at=dt.datetime(2099, 2, 1))
    land(base, 2, "Vienna")
    attempts = []

    def other():
        attempts.append(head(spark, f"{wh}/{MART_DIR}").number)
        if len(attempts) == 1:
            land(base, 3, "Berlin")
            refresh_all(spark, base, wh, city_count=3, run_at=dt.datetime(2099, 2, 3))

    done = refresh_all(spark, base, wh, city_count=3, run_at=dt.datetime(2099, 2, 2), before_commit=other)
    assert attempts == [1]  # overtaken; the winner covered its load as well, so nothing is left to publish
    assert all(r.passed for r in done["checks"].collect())
    full = refresh_all(spark, base, str(tmp_path / "full"), city_count=3, run_at=dt.datetime(2099, 2, 4), rebuild=True)
    assert snapshot(published_marts(spark, wh)) == snapshot(done["marts"]) == snapshot(full["marts"])
    assert {r[0] for r in snapshot(done["marts"])["city_current_weather"]} == {"Prague", "Vienna", "Berlin"}
    assert unpublished_loads(spark, wh) == []


def test_a_publisher_that_is_overtaken_derives_its_marts_anew(spark, tmp_path):
    """The winner publishes only its own load: the loser's has not been staged when the winner looks."""
    from strata.plans.refresh import publish_marts

    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    land(base, 1, "Prague")
    refresh_all(spark, base, wh, city_count=1, run_at=dt.datetime(2099, 2, 1))
    land(base, 2, "Vienna")
    load_raw(spark, base, wh, dt.datetime(2099, 2, 2))
    load_staging(spark, wh, "2099-02-02 00:00:00")
    numbers = []

    def winner():
        numbers.append(head(spark, f"{wh}/{MART_DIR}").number)
        if len(numbers) == 1:
            publish_marts(spark, wh, "2099-02-02 00:00:01")
            land(base, 3, "Berlin")
            load_raw(spark, base, wh, dt.datetime(2099, 2, 3))
            load_staging(spark, wh, "2099-02-03 00:00:00")

    version = publish_marts(spark, wh, "2099-02-02 00:00:00", before_commit=winner)
    assert numbers == [1, 2] and version.number == 3
    assert {r[0] for r in snapshot(published_marts(spark, wh))["city_current_weather"]} == {"Prague", "Vienna", "Berlin"}


def test_two_loads_that_meet_hold_each_document_once(spark, tmp_path, landing, monkeypatch):
    import os

    from strata.plans import refresh

    wh, real, met = str(tmp_path / "wh"), refresh._append, []

    def append(*args):
        if not met:  # both have read the log; the other run is faster
            met.append(load_raw(spark, landing, wh, dt.datetime(2099, 1, 5)) if not met.append(None) else None)
        return real(*args)

    monkeypatch.setattr(refresh, "_append", append)
    assert load_raw(spark, landing, wh, dt.datetime(2099, 1, 4)) == {"inserted": 0, "skipped": 5, "total": 5}
    assert met[1] == {"inserted": 5, "skipped": 0, "total": 5}
    assert read_table(spark, wh, RAW_TABLE).count() == 5
    assert len([n for n in os.listdir(f"{wh}/{RAW_TABLE}") if n.startswith(LOAD)]) == 1


def test_a_version_writes_what_new_rows_touch(spark, tmp_path):
    import os

    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    for k in range(30):
        land(base, 1, f"City {k}")
    first = refresh_all(spark, base, wh, city_count=30, run_at=dt.datetime(2099, 2, 1))
    land(base, 2, "City 7", days=DAYS[2:] + ["2026-03-20", "2026-03-21"])
    second = refresh_all(spark, base, wh, city_count=30, run_at=dt.datetime(2099, 2, 2))
    version = head(spark, f"{wh}/{MART_DIR}")
    assert (first["version"], version.parent, second["version"]) == (version.parent, first["version"], version.name)
    for table, entry in version.tables.items():
        wrote = [b for b, w in entry["parts"].items() if w == version.name]
        assert len(wrote) == (9 if table == "daily_temperature_rankings" else 1), table
        stored = os.listdir(f"{wh}/{MART_DIR}/data/{table}/in_write={version.name}")
        assert sorted(n for n in stored if n.startswith("in_bucket=")) == sorted(f"in_bucket={b}" for b in wrote)
    full = refresh_all(spark, base, str(tmp_path / "full"), city_count=30, run_at=dt.datetime(2099, 2, 2), rebuild=True)
    assert snapshot(second["marts"]) == snapshot(full["marts"])
    scanned = collect_checks(second["marts"], 30).orderBy("check_order").collect()
    assert second["checks"].orderBy("check_order").collect() == scanned
    assert full["checks"].orderBy("check_order").collect() == scanned
    plan = second["checks"]._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in plan.lower()


def test_counters_follow_faults_through_versions(spark, tmp_path):
    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    hot, wet = ([95.0] * 7, [1.0] * 7, [0.0] * 7), ([5.0] * 7, [9.0] * 7, [-1.0] * 7)
    for k in range(12):
        land(base, 1, f"City {k}", daily=hot if k % 3 == 0 else wet)
    issues = []
    for day in (2, 3):
        done = refresh_all(spark, base, wh, city_count=12, run_at=dt.datetime(2099, 2, day))
        assert sorted(done["checks"].collect()) == sorted(collect_checks(done["marts"], 12).collect())
        issues.append({r["name"]: r["issue_count"] for r in done["checks"].collect()})
        land(base, 2, "City 0")  # mended
    assert [i["mart_daily_temperature_ranges"] for i in issues] == [12 * 7, 11 * 7]
    assert [i["mart_daily_precipitation_ranges"] for i in issues] == [8 * 7, 8 * 7]


def test_keys_are_compared_with_the_touched_days_only(spark, tmp_path):
    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    for day in range(1, 5):
        land(base, day, "Prague")
        load_raw(spark, base, wh, dt.datetime(2099, 2, day))
    entries = read_log(spark, f"{wh}/{RAW_LOG}")
    assert [e["days"] for e in entries] == [[f"2099-01-0{d}"] for d in range(1, 5)]
    known = known_paths(spark, wh, entries, [("2099", "01", "03")])
    assert known.count() == 1
    plan = known._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert f"= {entries[2][LOAD]}" in filters and "concat_ws(-, ye" in filters  # one load of four, one day
    assert load_raw(spark, base, wh, dt.datetime(2099, 2, 9)) == {"inserted": 0, "skipped": 4, "total": 4}
    assert len(read_log(spark, f"{wh}/{RAW_LOG}")) == 4  # nothing to say


def test_names_with_blanks_and_escapes_load_once(spark, tmp_path):
    base, wh = str(tmp_path / "landing"), str(tmp_path / "wh")
    for name in ("new york", "a+b", "50%25", "z\u00fcrich"):
        write_doc(base, FIXTURE_RUN, name, forecast_document("Prague") | {"city": name})
    assert refresh_all(spark, base, wh, city_count=4, run_at=dt.datetime(2099, 2, 1))["raw"]["inserted"] == 4
    stored = {r[0] for r in read_table(spark, wh, RAW_TABLE).select("raw_file_path").collect()}
    assert stored == {f"{FIXTURE_RUN}/city={n}.json" for n in ("new york", "a+b", "50%25", "z\u00fcrich")}
    write_doc(base, FIXTURE_RUN, "oslo", forecast_document("Prague") | {"city": "Oslo"})
    assert refresh_all(spark, base, wh, city_count=5, run_at=dt.datetime(2099, 2, 2))["raw"] == {"inserted": 1, "skipped": 4, "total": 5}


def test_a_document_that_keeps_failing_is_one_reject(spark, tmp_path, landing):
    wh, doc = str(tmp_path / "wh"), forecast_document("Prague")
    doc["payload"]["api_response"]["daily"]["time"] = None
    write_doc(landing, DAY2, "prague", doc)
    for day in (1, 2, 3):
        with pytest.raises(ValueError, match="Malformed daily arrays: 1 fields"):
            refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 2, day))
    assert spark.read.parquet(f"{wh}/{REJECTS}").count() == 1


def test_staging_parses_a_document_once(spark, tmp_path, landing):
    """Both staging tables and the rejects come from one wide table; no join brings the load back."""
    from strata.plans import weather as W

    wh = str(tmp_path / "wh")
    refresh_all(spark, landing, wh, city_count=5, run_at=dt.datetime(2099, 2, 1))
    flat = W.flatten_documents(read_table(spark, wh, RAW_TABLE), [LOAD])
    for rows in (W.current_rows(flat, carry=[LOAD]), W.daily_rows(flat, carry=[LOAD])):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and plan.count("FileScan parquet") == 1
        assert LOAD in rows.columns
