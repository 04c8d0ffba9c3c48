from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.functions import iso_utc_z, lookup_key, parse_iso_instant, run_id, slug, to_decimal
from strata.sources.lookup import city_dimension, lookup_dimension, raise_on_rejects, request_plan
from strata.sources.raw_documents import with_partition_columns


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_partition_path_golden(spark):
    df = spark.createDataFrame([("Prague", dt.datetime(2026, 3, 13, 12, 30))], "city string, run_at timestamp")
    row = with_partition_columns(df, "city", "run_at").first()
    assert row.raw_file_path == "source=open_meteo/year=2026/month=03/day=13/run_id=20260313T123000Z/city=prague.json"
    assert (row.year, row.month, row.day, row.run_id) == ("2026", "03", "13", "20260313T123000Z")


def test_slug_and_lookup_key(spark):
    r = one(spark, slug(F.lit("  New York ")).alias("s"), lookup_key(F.lit("  Prague ")).alias("k"))
    assert (r.s, r.k) == ("new_york", "prague")


def test_iso_formatting_fraction_only_when_nonzero(spark):
    r = one(
        spark,
        iso_utc_z(F.lit("2026-03-13 19:45:00").cast("timestamp")).alias("a"),
        iso_utc_z(F.lit("2026-03-13 19:45:00.250000").cast("timestamp")).alias("b"),
        run_id(F.lit("2026-03-13 19:45:07").cast("timestamp")).alias("c"),
    )
    assert r.a == "2026-03-13T19:45:00Z"
    assert r.b == "2026-03-13T19:45:00.250000Z"
    assert r.c == "20260313T194507Z"


def test_instants_are_read_by_one_grammar(spark):
    good = {
        "2026-03-13T19:45:00Z": dt.datetime(2026, 3, 13, 19, 45), "2026-03-13T21:45:00+02:00": dt.datetime(2026, 3, 13, 19, 45),
        "2026-03-13T17:15-0230": dt.datetime(2026, 3, 13, 19, 45), "2026-03-13 19:45": dt.datetime(2026, 3, 13, 19, 45),
        "2026-03-13T19:45:00.25Z": dt.datetime(2026, 3, 13, 19, 45, 0, 250_000), "2026-03-13T19:45:00,1234567": dt.datetime(2026, 3, 13, 19, 45, 0, 123_456),
        "2026-03-13": dt.datetime(2026, 3, 13),
    }
    bad = ["12:30", "2031", "T12:30:00", "2026-03", "2026-3-1", "2026-02-30", "2026-03-13T24:30", "2026-03-13T12", "2026-03-13T12:30 Europe/Oslo", " 2026-03-13", "now", "", None]
    rows = spark.createDataFrame([(t,) for t in [*good, *bad]], "t string").select("t", parse_iso_instant("t").alias("at")).collect()
    assert {r.t: r.at for r in rows} == {**good, **dict.fromkeys(bad)}


def test_decimal_half_up_and_overflow(spark):
    r = one(spark, to_decimal(F.lit("1.005"), 6, 2).alias("a"), to_decimal(F.lit("-1.005"), 6, 2).alias("b"))
    assert (r.a, r.b) == (Decimal("1.01"), Decimal("-1.01"))
    with pytest.raises(PySparkException):
        one(spark, to_decimal(F.lit("12345.678"), 6, 2).alias("x"))


def test_dimension_lookup_normalises_and_rejects(spark):
    cities = spark.createDataFrame([("  Prague ",), ("London",), ("VIENNA",)], "name string")
    plan, rejects = request_plan(cities, "name", city_dimension(spark))
    got = {r.name: (r.latitude, r.longitude, r.forecast_days, r.timezone) for r in plan.collect()}
    assert got["  Prague "] == (50.0755, 14.4378, 7, "UTC")
    assert "VIENNA" in got
    assert [r.name for r in rejects.collect()] == ["London"]
    with pytest.raises(ValueError, match="1 requested names have no coordinates, the first is 'London'"):
        raise_on_rejects(rejects, "name")


def test_lookup_leaves_the_join_to_the_planner_and_refuses_ambiguous_names(spark):
    facts = spark.range(100).select(F.concat(F.lit("n"), (F.col("id") % 7).cast("string")).alias("name"))
    dim = spark.range(7).select(F.concat(F.lit("N"), F.col("id").cast("string")).alias("key"), F.col("id").alias("v"))
    matched, rejects = lookup_dimension(facts, "name", dim, "key")
    assert "strategy=broadcast" not in matched._jdf.queryExecution().logical().toString()
    assert matched.count() == 100 and rejects.count() == 0
    twice = dim.unionByName(spark.createDataFrame([(" n3 ", 9)], "key string, v long"))
    with pytest.raises(PySparkException, match="several dimension entries"):
        lookup_dimension(facts, "name", twice, "key")[0].collect()


def test_scale_conf_sizes_partitions():
    from strata.session import scale_conf

    big = scale_conf(100 * 1024**4)  # 100 TB
    assert big["spark.sql.shuffle.partitions"] == "200000"
    mid = scale_conf(1024**4)  # 1 TB / 256 MB
    assert mid["spark.sql.shuffle.partitions"] == "4096"
    assert scale_conf(1024)["spark.sql.shuffle.partitions"] == "200"
    assert mid["spark.sql.files.maxPartitionBytes"] == "256m"


def test_tune_for_inputs_measures_files(spark):
    import os

    from conftest import SF_SMALL

    from strata.session import input_bytes, scale_conf, tune_for_inputs

    path = f"{SF_SMALL}/lineitem.parquet"
    assert input_bytes(spark, [path]) == os.path.getsize(path)
    keys = list(scale_conf(0))
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        conf = tune_for_inputs(spark, [path])
        assert conf["spark.sql.shuffle.partitions"] == "200"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
