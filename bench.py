"""Benchmark the headline queries.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1) and prints one JSON
line: {"metric": ..., "value": total seconds, "unit": "sec", "queries": {name: seconds}, "build": {name: seconds of
these that building the plan took}, "sf": ...}.
Each query is timed end to end (plan construction + full execution into a no-op sink, nothing
collected to the driver); the reported time is the median of $BENCH_REPEAT runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from admart.queries import QUERIES  # noqa: E402
from admart.session import build_session  # noqa: E402

HEADLINE = [
    "all_ads_daily",
    "daily_google_ads",
    "meta_aov_corrected",
    "sku_sales_by_period",
    "orders_by_period",
    "keyword_brand",
    "orders_sessions",
    "monthly_users",
]


def run_once(spark, name: str, sf_dir: str) -> tuple[float, float]:
    """Seconds in all, and of these for building the plan."""
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    built = time.perf_counter() - t0
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0, built


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * cpus, app="admart-bench")
    timings: dict[str, float] = {}
    build: dict[str, float] = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up: JIT, file listing, lookup tables
        runs = [run_once(spark, name, sf_dir) for _ in range(repeat)]
        timings[name] = round(statistics.median(r[0] for r in runs), 3)
        build[name] = round(statistics.median(r[1] for r in runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "build": build,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
