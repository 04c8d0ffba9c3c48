from __future__ import annotations

import datetime as dt

from conftest import forecast_document, write_doc

from strata.plans.refresh import RAW_LOG, RAW_TABLE, read_table
from strata.sources.commits import read_log
from strata.streaming.ingest import ingest_available


def test_available_now_loads_each_file_once(spark, landing, tmp_path):
    wh, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2099, 1, 2))
    assert read_table(spark, wh, RAW_TABLE).count() == 5
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2099, 1, 3))
    assert read_table(spark, wh, RAW_TABLE).count() == 5
    run2 = "source=open_meteo/year=2099/month=01/day=02/run_id=20990102T000000Z"
    write_doc(landing, run2, "prague", forecast_document("Prague", ingested="2099-01-02T00:00:00Z"))
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2099, 1, 4))
    raw = read_table(spark, wh, RAW_TABLE)
    assert raw.count() == 6
    assert raw.where("city = 'Prague'").count() == 2


def test_a_batch_that_is_replayed_after_a_crash_is_one_load(spark, landing, tmp_path):
    """The crash comes after the load's entry and before the stream's commit: the batch runs again."""
    import os

    wh, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2099, 1, 2))
    for name in ("0", ".0.crc"):
        os.remove(f"{ck}/commits/{name}")
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2099, 1, 3))
    entries = read_log(spark, f"{wh}/{RAW_LOG}")
    assert len(entries) == 1 and entries[0]["batch"].endswith("-0")
    assert read_table(spark, wh, RAW_TABLE).count() == 5
    # Another stream over the same files has batches of its own and finds nothing new.
    ingest_available(spark, landing, wh, str(tmp_path / "ck2"), run_at=dt.datetime(2099, 1, 4))
    assert read_table(spark, wh, RAW_TABLE).count() == 5


def test_spark_written_landing_round_trip(spark, tmp_path):
    from pyspark.sql import functions as F

    from strata.sources.envelope import build_envelope, parse_envelope
    from strata.sources.raw_documents import read_raw_documents, with_partition_columns, write_raw_documents

    rows = spark.createDataFrame(
        [("Lagos", dt.datetime(2031, 11, 2, 4, 5, 6)), ("Buenos Aires", dt.datetime(2031, 11, 2, 4, 5, 6))],
        "city string, run_at timestamp",
    )
    staged = with_partition_columns(rows, "city", "run_at", source_dir="buoys")
    docs = build_envelope(staged, "city", F.struct(F.col("city").alias("city")), "run_at",
                          keep=["year", "month", "day", "run_id", "city_slug", "raw_file_path"])
    base = str(tmp_path / "landing")
    write_raw_documents(docs, base, source_dir="buoys")
    back = read_raw_documents(spark, base, source_dir="buoys")
    run = "source=buoys/year=2031/month=11/day=02/run_id=20311102T040506Z"
    assert {r.raw_file_path for r in back.collect()} == {f"{run}/city={slug}.json" for slug in ("lagos", "buenos_aires")}
    good, rejects = parse_envelope(back, on_error="reject")
    assert rejects.count() == 0 and {r.city for r in good.collect()} == {"Lagos", "Buenos Aires"}


def test_no_landing_files_is_an_empty_read(spark, tmp_path):
    from strata.sources.raw_documents import read_raw_documents

    assert read_raw_documents(spark, str(tmp_path / "nothing")).count() == 0


def test_streaming_ingest_then_refresh_from_raw(spark, landing, tmp_path):
    from strata.plans.refresh import pending_loads, refresh_from_raw

    wh, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    ingest_available(spark, landing, wh, ck, run_at=dt.datetime(2099, 1, 2))
    assert len(pending_loads(spark, wh)) == 1
    res = refresh_from_raw(spark, wh, city_count=5, run_at=dt.datetime(2099, 1, 2, 1))
    assert res["marts"]["daily_city_weather_summary"].count() == 35
    assert all(r.passed for r in res["checks"].collect())
    assert pending_loads(spark, wh) == []
