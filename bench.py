"""Benchmark: wall time of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farebox.plans.catalog import REGISTRY  # noqa: E402
from farebox.session import get_spark  # noqa: E402

HEADLINE = [
    "hourly_revenue_outer_zones",
    "hourly_revenue_full_join",
    "monthly_revenue_zone",
    "monthly_revenue_service",
    "exact_dedupe_fact",
    "dedupe_keep_one_a",
    "dedupe_keep_one_z",
    "daily_report",
    "dup_report",
    "dup_excess",
    "tag_month",
    "top_tags",
    "quality_report",
    "tumble_zone",
    "session_keyed",
    "session_global",
    "longest_duration",
    "predict_duration",
    "stream_tumble_zone",
    "stream_session_global",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(master=f"local[{cpus}]", app="farebox-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    # Warm-up, not timed: every headline query once on the smallest scale
    # (JIT, codegen caches, Python workers), so the timed pass measures the
    # queries and not the first use of the JVM.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name in HEADLINE:
            REGISTRY[name][0](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        fn = REGISTRY[name][0]
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
