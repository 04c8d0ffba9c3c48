"""Plan-shape guarantees the scale design relies on, and a hot-key run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from strata.plans import events as E
from strata.plans.catalog import QUERIES
from strata.sources.envelope import parse_envelope


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_events(spark, n=30_000):
    """One user holds a third of all rows, the rest are spread over 500 users."""
    base = dt.datetime(2024, 1, 1)
    return spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.lit(base) + F.make_interval(secs=F.col("id") * 60)).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit(100_000)).otherwise(F.col("id") % 500).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"),
        ((F.col("id") % 1000) / 10).cast("double").alias("value"),
        F.concat(F.lit('{"k": '), (F.col("id") % 100).cast("string"), F.lit("}")).alias("props"),
    )


def test_documents_aggregate_map_side_and_by_hash(spark):
    docs = E.forecast_documents(hot_events(spark, 3000))
    plan = executed(docs)
    assert "SortAggregate" not in plan
    assert "partial_max" in plan  # combined before the first exchange


def test_hot_user_documents_stay_bounded(spark):
    ev = hot_events(spark)
    docs = E.forecast_documents(ev)
    good, rejects = parse_envelope(docs.select("value", "raw_file_path"), on_error="reject")
    sizes = good.select(F.size(F.try_variant_get("payload", "$.api_response.daily.time", "array<string>")).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 7
    assert rejects.count() == 0
    hot = ev.where("user_id = 100000").agg(F.count(F.lit(1))).first()[0]
    assert hot == 10_000


def test_no_cartesian_or_python_in_catalog(spark):
    from conftest import SF_SMALL

    for name in ["latest_per_key", "daily_summary", "rank_per_day", "rolling_metrics", "overview", "dq_checks", "contract_fk"]:
        plan = executed(QUERIES[name](spark, SF_SMALL))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SortAggregate"):
            assert bad not in plan, (name, bad)
