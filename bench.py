"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (full execution, no
collect); the first run of the session is a warm-up and is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contrail.plans import catalog  # noqa: E402
from contrail.session import local_session  # noqa: E402

HEADLINE = [
    "enrich_left_join",
    "country_window_agg",
    "rapid_descent_alerts",
    "live_snapshot",
    "alerts_table",
    "kpi_summary",
    "top_countries",
    "trend_top_countries",
    "velocity_histogram",
    "alert_log",
    "src_snapshot_decode",
    "json_decode",
    "stream_country_window_agg",
    "stream_live_snapshot",
    "stream_pipeline_alerts",
]


def run(spark, fn, sf_dir):
    df = fn(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if str(cpus).isdigit() else 8, app="contrail-bench")
    qs = catalog.queries()
    run(spark, qs["country_window_agg"], sf_dir)  # warm-up
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(spark, qs[name], sf_dir)
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
