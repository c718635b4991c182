"""Time the headline queries; prints one JSON line.

Every query runs ``BENCH_RUNS`` times (default 2) to the last row and column; the best
time counts, and the first is reported next to it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "gold_order_lines",
    "gold_user_purchases",
    "stg_users",
    "stg_purchases",
    "dim_users",
    "dim_products",
    "fct_purchases",
    "user_last_purchase",
    "check_suite",
    "top_spenders",
    "geo_revenue",
    "weekly_kpi",
    "obs_pass_rate_trend",
    "obs_invocation_history",
    "obs_test_coverage",
    "dedup_latest",
    "incr_upsert",
    "scd2_snapshot",
    "compare_relations",
    "stream_dedup",
    "full_build",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    shared = tempfile.TemporaryDirectory(prefix="bench-")  # one machine: its own folder is shared
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.checkpoint.dir", f"{shared.name}/shared")
        .config("spark.sql.warehouse.dir", f"{shared.name}/warehouse")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    best, first = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds = round(time.perf_counter() - started, 3)
            first.setdefault(name, seconds)
            best[name] = min(best.get(name, seconds), seconds)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of runs, total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first_run": first,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()
    shared.cleanup()


if __name__ == "__main__":
    main()
