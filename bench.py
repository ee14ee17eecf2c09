"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_MEMORY   driver memory (default 16g)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)
BENCH_RUNS     runs of each query, of which the median counts (default 3)
BENCH_SMALL    folder with ten times smaller tables, run beside it to show growth (default: sf0.01 beside the other)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costalloc.plans.catalog import QUERIES, store_report_fact  # noqa: E402
from costalloc.session import build_session  # noqa: E402

HEADLINE = [
    "correlated_fact",
    "correlated_fact_reference",
    "alloc_proportional",
    "alloc_time_weighted",
    "usage_by_window",
    "src_events",
    "src_traces",
    "dedup_telemetry",
    "reconcile_allocation",
    "dq_rules",
    "correlation_summary",
    "cost_breakdowns",
    "device_performance",
    "store_hierarchy_rollup",
    "device_rank",
    "trailing_30d_cost",
    "cost_anomaly_2sigma",
    "kpi_core",
    "shift_pivot",
    "star_join",
    "device_usage_patterns",
    "predict_cost",
    "device_spillover",
    "write_fact",
    "stream_usage_window",
    "range_summary",
    "device_correlation_index",
    "alloc_exact",
    "scheduled_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    memory = os.environ.get("BENCH_MEMORY", "16g")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.driver.memory": memory,
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="costalloc-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def write_reports(folder: str) -> float:
        start = time.perf_counter()
        store_report_fact(spark, folder)
        return round(time.perf_counter() - start, 3)

    run("correlated_fact", sf_dir)  # warm-up: class loading and first compilation
    # what reports read is written once, before them, and counts as a line of its own
    seconds = {"report_fact_write": write_reports(sf_dir)}
    seconds |= {name: median(run(name, sf_dir) for _ in range(runs)) for name in names}
    small = os.environ.get("BENCH_SMALL", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01"))
    beside = {}
    if os.path.isdir(small) and small != sf_dir:
        beside = {"report_fact_write": write_reports(small)} | {name: run(name, small) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the benchmark queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "queries_small": beside,
                "runs": runs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "memory": memory,
            }
        )
    )


if __name__ == "__main__":
    main()
