"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder and BENCH_CPUS the local cores. All queries
run once to warm up the JVM and then BENCH_REPEATS times; medians are reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillcast.session import build_session  # noqa: E402
from tillcast.workload.registry import QUERIES  # noqa: E402

HEADLINES = [
    "daily_mart", "hourly_mart", "product_mart", "sales_fanout", "fanout_audit", "fct_sales_local",
    "fct_items", "weather_dedup", "forecast_fact", "payload_explode", "receipts_distinct",
    "share_of_day", "sales_period_range_join", "upsert_latest", "dq_marts_match", "dq_items_receipts",
    "dq_unique_combo", "rollup_receipts",
]


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    for name in names:
        run(spark, folder, name)
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(spark, folder, name) for _ in range(repeats)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_median_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "repeats": repeats,
            }
        )
    )


if __name__ == "__main__":
    main()
