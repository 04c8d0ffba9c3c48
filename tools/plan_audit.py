"""Summarise the physical plan of every catalog query (exchanges, aggregates, scans).

usage: python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.catalog import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402

SKIP = {"full_refresh", "incremental_ingest"}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: what a cluster would start from
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(k, plan)) for k in [
            "Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
            "SortMergeJoin", "BroadcastHashJoin", "CartesianProduct", "BroadcastNestedLoopJoin",
            "SortAggregate", "ObjectHashAggregate", "HashAggregate", "Window", "WindowGroupLimit", "ArrowEvalPython", "BatchEvalPython",
        ]}
        reads = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
        print(name, {k: v for k, v in counts.items() if v}, "reads:", sorted(set(reads))[:4])
    spark.conf.set("spark.sql.adaptive.enabled", "true")


if __name__ == "__main__":
    main()
