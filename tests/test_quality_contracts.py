from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from strata.operators import contracts as K
from strata.operators import quality as Q


def results(spark, rows):
    return spark.createDataFrame(rows, "check_order int, name string, description string, issue_count bigint, passed boolean")


def test_roll_up_counts_and_names_what_failed(spark):
    rows = [(1, "blanks", "", 7, False), (2, "ranges", "", 0, True), (3, "keys", "", 2, False), (4, "rows", "", 0, True), (5, "more rows", "", 1, False)]
    roll = Q.summarize_checks(results(spark, rows)).first()
    assert (roll.passed, roll.failed, roll.total, roll.status) == (2, 3, 5, "fail")
    with pytest.raises(RuntimeError, match=r"3 of the quality checks found issues: blanks \(7\), keys \(2\), more rows \(1\)"):
        Q.assert_checks(results(spark, rows))


def test_roll_up_of_checks_that_all_pass_and_of_none(spark):
    good = results(spark, [(1, "blanks", "", 0, True)])
    assert tuple(Q.summarize_checks(good).first()) == (1, 0, 1, "pass")
    Q.assert_checks(good)
    assert tuple(Q.summarize_checks(good.limit(0)).first()) == (0, 0, 0, "pass")


def test_no_table_holds_a_negative_number_of_rows():
    assert Q.expected_count(0) == 0
    with pytest.raises(ValueError, match="-3 rows"):
        Q.expected_count(-3)


def test_quality_document_without_current_rows(spark):
    marts = {
        "city_current_weather": spark.createDataFrame([], "city string, current_time_utc timestamp, source_ingested_at_utc timestamp"),
        "daily_city_weather_summary": spark.createDataFrame([], "city string, forecast_date date, temperature_max_c decimal(6,2), temperature_min_c decimal(6,2), precipitation_mm decimal(8,2), source_ingested_at_utc timestamp"),
        "daily_temperature_rankings": spark.range(0), "city_rolling_3day_metrics": spark.range(0),
    }
    assert Q.quality_payload(marts, 2) == {"status": "not_ready", "summary": {"passed": 0, "failed": 0, "total": 0}, "items": []}


def test_range_rules_ignore_nulls(spark):
    df = spark.createDataFrame([(Decimal("10.00"), Decimal("20.00")), (None, Decimal("1.00")), (Decimal("81.00"), Decimal("0.00"))],
                               "mx decimal(6,2), mn decimal(6,2)")
    counters = Q.table_counters(df, "t", {"r": (F.col("mx") < F.col("mn")) | Q.not_between("mx", -80, 80)})
    assert counters.first().r == 2


def test_counters_of_one_scan(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 1), ("c", 2)], "k string, d int")
    one = Q.table_counters(df, "t", {"twos": F.col("d") == 2}, unique=["k", "d"])
    assert one.first().asDict() == {"t_rows": 5, "t_duplicates": 2, "twos": 1}
    assert one._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 2  # one in each of the two plans shown
    assert Q.table_counters(df.limit(0), "t", {"twos": F.col("d") == 2}, unique=["k"]).first().asDict() == {"t_rows": 0, "t_duplicates": 0, "twos": 0}
    checks = [Q.Check("rows", "", Q.is_not("t_rows", F.lit(5))), Q.Check("more", "", Q.is_not("t_rows", F.lit(4))), Q.Check("twos", "", F.col("twos"))]
    assert [(r.check_order, r.name, r.issue_count, r.passed) for r in Q.check_rows([one], checks).collect()] == [(1, "rows", 0, True), (2, "more", 1, False), (3, "twos", 1, False)]


def test_contracts(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, "x"), (3, None), (None, "y")], "pid long, v string")
    assert [r.pid for r in K.fk_violations(child, parent, ["pid"], ["id"]).collect()] == [3]
    nn = K.not_null_violations(child, ["pid", "v"], keys=["v"]).collect()
    assert sorted((r.v, r.column) for r in nn if r.v) == [("y", "pid")]
    assert K.unique_violations(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"]).first().n == 2


def test_apply_schema_reject_and_raise(spark):
    df = spark.createDataFrame([(1, "12.345"), (2, "12345.6"), (3, None)], "id int, t string")
    schema = StructType([StructField("t", DecimalType(6, 2))])
    typed, rejects = K.apply_schema(df, schema, keys=["id"], on_error="reject")
    assert sorted((r.id, r.t) for r in typed.collect()) == [(1, Decimal("12.35")), (3, None)]
    assert [(r.id, r.column, r.value) for r in rejects.collect()] == [(2, "t", "12345.6")]
    strict, _ = K.apply_schema(df, schema, keys=["id"], on_error="raise")
    with pytest.raises(PySparkException):
        strict.collect()


def test_create_if_absent_and_declared_not_null(spark, tmp_path):
    from strata.schemas import MART_DAILY_SUMMARY, TABLES, create_if_absent, not_null_columns

    wh = str(tmp_path / "wh")
    assert sorted(create_if_absent(spark, wh)) == sorted(TABLES)
    assert create_if_absent(spark, wh) == []
    assert spark.read.parquet(f"{wh}/mart/daily_city_weather_summary").schema.fieldNames() == MART_DAILY_SUMMARY.fieldNames()
    assert "is_wet_day" in not_null_columns(MART_DAILY_SUMMARY)


def test_foreign_keys_at_once_match_one_by_one(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c")], "id int, code string")
    child = spark.createDataFrame([(1, 2, "a"), (3, 2, "x"), (3, 9, None), (4, None, "b"), (None, 1, "a")], "p long, q long, c string")
    empty = child.limit(0)
    keys = [
        K.ForeignKey("p", child, "p", parent, "id"), K.ForeignKey("p of a", child, "p", parent, "id", F.col("code") == "a"), K.ForeignKey("q", child, "q", parent, "id"),
        K.ForeignKey("code", child, "c", parent, "code"), K.ForeignKey("none", empty, "p", parent, "id"), K.ForeignKey("orphaned", child, "p", parent.limit(0), "id"),
    ]
    got = {r.contract: r.violations for r in K.fk_violation_counts(keys).collect()}
    one = {k.name: K.fk_violations(k.child, k.parent if k.where is None else k.parent.where(k.where), [k.key], [k.parent_key]).count() for k in keys}
    assert got == one == {"p": 3, "p of a": 3, "q": 1, "code": 1, "none": 0, "orphaned": 4}


def test_foreign_keys_scan_a_child_once(spark):
    from conftest import SF_SMALL

    from strata.plans.catalog import q_contract_fk

    plan = q_contract_fk(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("lineitem.parquet") == 1 and initial.count("orders.parquet") == 2  # as a child and as a parent


def test_iso_json_serialises_dates_and_instants(spark):
    import datetime as dt
    import json

    from strata.operators.views import iso_json, iso_strings

    df = spark.createDataFrame(
        [("Prague", dt.date(2026, 3, 13), dt.datetime(2099, 1, 1), Decimal("1.50"))],
        "city string, d date, ts timestamp, x decimal(6,2)",
    )
    row = iso_strings(df).first()
    assert (row.d, row.ts, row.x) == ("2026-03-13", "2099-01-01T00:00:00+00:00", Decimal("1.50"))
    doc = json.loads(iso_json(df).first().value)
    assert doc == {"city": "Prague", "d": "2026-03-13", "ts": "2099-01-01T00:00:00+00:00", "x": 1.5}
