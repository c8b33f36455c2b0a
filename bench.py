"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 3); the median counts. The whole
result is computed and thrown away by the noop sink, so nothing passes through the driver.
Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from waterline.session import configure  # noqa: E402

# Reports, collection and trends, the operators that carry them, sinks and document feeds. Those on stored facts are
# left to BENCH_QUERIES: their warm-up stores the facts.
HEADLINE = [
    name
    for name in QUERIES
    if (name[0] in "rcd" and "_stored_" not in name)
    or name in ("j1_latest_ties", "j3_prev_ok", "j6_object_prev", "j8_aligned_last_vs_prev")
    or name in ("w1_rank_objects", "a1_instance_storage", "k4_asset_upsert_fill")
    or name[:3] in ("k1_", "k2_", "k3_", "s3_")
]


def session(cpus: str) -> SparkSession:
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]"), shuffle_partitions=int(cpus))
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in names:
        seconds(spark, sf_dir, name)
        times[name] = round(
            statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3
        )
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
