"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local cores,
``BENCH_RUNS`` the number of timed runs per query (the best one counts).
"""

from __future__ import annotations

import json
import os
import time

from stocktide.plans import catalog
from stocktide.session import build_session

HEADLINES = [
    "sales_daily", "daily_store_revenue", "top_stores", "product_performance", "latest_inventory",
    "latest_customer", "dedup_orders", "genre_avg", "movie_stats", "user_avg", "device_summary",
    "tumbling_minute", "tumbling_hour", "sliding_hour", "session_30m", "device_windows",
    "merge_inventory", "merge_customer", "validate_orders", "validate_customers",
    "contract_violations", "filter_ok", "as_of_version", "version_diff", "numbered_devices", "late_flags",
    "bucket_counts", "clustered_read", "stream_filter_ok", "stream_window_updates",
]


def timed(run, times: int) -> float:
    best = float("inf")
    for _ in range(times):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = catalog.queries()
    catalog.queries()["scan_count"](spark, sf_dir).collect()
    seconds = {name: round(timed(lambda: every[name](spark, sf_dir), runs), 3) for name in HEADLINES}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
