"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; the median is reported. Rows are computed
in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from workload import catalog

HEADLINES = [
    "parse_cdr",
    "enrich_by_imsi",
    "enrich_by_ip",
    "enrich_by_ip_sliced",
    "enrich",
    "stream_enrich",
    "partitioned_roundtrip",
    "compact_roundtrip",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    medians = {}
    for name in chosen:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            catalog.run(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        medians[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    result = {
        "metric": "sum of median query times",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
