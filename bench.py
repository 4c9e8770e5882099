"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from eventmart.plans.queries import QUERIES

HEADLINE = [
    "equity_on_change", "equity_all", "line_stats", "config_gate", "live_as_of", "item_classes", "trades",
    "upsert_equity", "upsert_merged", "archive_rows", "registry", "compact_day", "compact_week", "archive_slice", "time_range", "mode_files",
    "distinct_ts", "equity_with_candle", "new_files", "partition_names", "batch_on_change",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    # once untimed: class loading and code generation
    QUERIES["equity_on_change"](spark, sf_dir).count()
    seconds = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    total = round(sum(seconds.values()), 3)
    flagship = seconds["equity_on_change"]
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_time", "value": total, "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "flagship_lines_per_sec": round(lines / flagship),
    }))


if __name__ == "__main__":
    main()
