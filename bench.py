"""Times the registered queries on one machine and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all), BENCH_RUNS (default 3;
the fastest run counts), BENCH_ONLY (comma-separated query names). A query's time includes
building its plan and any check made while building it; rows go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from annexport.plans.queries import QUERIES
from annexport.session import SETTINGS


def session(cpus: int, folder: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("annexport-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.checkpoint.dir", folder)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    scratch = tempfile.TemporaryDirectory(prefix="bench-")  # what the queries write and read back
    spark = session(cpus, scratch.name)
    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken = time.perf_counter() - start
            best = taken if best is None else min(best, taken)
        seconds[name] = round(best, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
