"""Counts what moves data in the executed plan of each query, as one JSON line per query."""

from __future__ import annotations

import json
import re
import sys

from pyspark.sql import SparkSession

from checks.queries import QUERIES

COUNTED = {
    "shuffles": r"(?<!Reused)(?<!Broadcast)\bExchange (hash|range|round|single)",
    "reused": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "scans": r"FileScan",
}


def counts(spark: SparkSession, sf_dir: str, name: str) -> dict[str, int]:
    result = QUERIES[name](spark, sf_dir)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    # A reused exchange names the one it repeats on the same line; that is not another shuffle.
    lines = [line for line in final.splitlines() if "ReusedExchange" not in line]
    found = {k: len(re.findall(p, "\n".join(lines))) for k, p in COUNTED.items()}
    return {**found, "reused": final.count("ReusedExchange")}


def main() -> None:
    sf_dir = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.autoBroadcastJoinThreshold", sys.argv[2] if sys.argv[2:] else "10MB")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[3:] or QUERIES:
        print(json.dumps({"query": name, **counts(spark, sf_dir, name)}), flush=True)


if __name__ == "__main__":
    main()
