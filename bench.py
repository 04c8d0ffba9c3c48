"""Time the catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Before timing, the same
queries run once over the smallest fixture (``$BENCH_WARMUP_DIR``) so JVM
start-up and JIT warm-up are not charged to whichever query happens to run
first. Written layers are keyed by their input, so the warm-up never serves
the timed run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.catalog import LAYERS, QUERIES, layer, line_documents  # noqa: E402
from strata.session import get_session, tune_for_inputs  # noqa: E402

HEADLINE = [
    "raw_envelope", "staging_current", "staging_daily", "latest_per_key", "mart_current",
    "latest_snapshot", "daily_summary", "rank_per_day", "rolling_metrics", "rolling_history",
    "dq_checks", "overview", "parallel_arrays", "ragged_arrays", "envelope_rejects",
    "idempotent_append", "json_extract", "partition_columns", "contract_unique", "contract_cast",
    "contract_fk", "contract_not_null", "dimension_lookup",
    "dimension_rejects", "append_counts", "dq_summary", "dq_driver_tables",
    "view_current", "view_daily", "view_rankings", "view_rolling", "view_json",
    "envelope_contract", "request_plan", "staging_repeated_dates", "latest_tied", "rank_per_day_nulls",
    "dq_spoiled", "quality_document", "readiness", "full_refresh", "incremental_ingest",
]


def build_layers(spark, sf_dir: str) -> None:
    for name in LAYERS:
        layer(spark, sf_dir, name)
    line_documents(spark, sf_dir)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="strata-bench")
    names = [n for n in HEADLINE if n in QUERIES]
    only = sys.argv[1:]
    if only:
        names = [n for n in names if n in only] or only
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        build_layers(spark, warm)
        for name in names:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    timings = {}
    # Partitions follow the measured input, as on a cluster; on one machine two a core are enough.
    tune_for_inputs(spark, [sf_dir], min_partitions=int(cpus) * 2)
    # The written layers (raw, staging, marts, line documents) are
    # built once per input version; time that build on its own line so each
    # query below is charged only for its own work. The total includes it.
    t0 = time.perf_counter()
    build_layers(spark, sf_dir)
    timings["build_layers"] = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "catalog_total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
