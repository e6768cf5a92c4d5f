"""Time the headline queries and print one JSON line.

Each query runs whole and its rows go to a sink that drops them. The first run of
a query warms the JVM; the reported time is the best of the following runs.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from barloom.plans.registry import QUERIES
from barloom.session import build_session

HEADLINE = [
    "adjusted_prices",
    "adjusted_prices_by_days",
    "adjusted_prices_by_steps",
    "adjusted_prices_multi_series",
    "parse_actions",
    "normalize_full",
    "consolidate",
    "price_table",
    "incremental_append",
    "merge_delivery",
    "bulk_with_prices",
    "bulk_with_prices_shuffled",
    "compare_prices",
    "accuracy",
    "top_mismatches",
    "security_master",
    "completeness_check",
    "dataset_summary",
    "duplicate_count",
    "duplicate_sources",
    "missing_dates",
    "files_full_prices",
    "files_actions",
    "store_prices_appended",
    "stream_full_prices_loaded",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "barloom-bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="barloom-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(min(run(name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
