"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINE = [
    "past_user",
    "past_user_item",
    "past_global_history",
    "past_by_country",
    "past_product_history",
    "txn_item_stats",
    "basket_description",
    "demographic_rates",
    "brand_category_rates",
    "rolling_refunds",
    "session_features",
    "traffic_rates",
    "pivot_event_count",
    "assemble_features",
    "clean_training",
    "describe_labels",
    "select_binary_label",
    "split_ordered",
    "resample",
    "split_metrics",
    "tier_comparison",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from registry import all_queries

    registered = all_queries()
    wanted = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    # Start the JVM's compilers on something unrelated to the measured queries.
    spark.read.parquet(f"{directory}/nation.parquet").groupBy("n_regionkey").count().collect()
    timings: dict[str, float] = {}
    for name in wanted:
        started = time.perf_counter()
        registered[name].build(spark, directory).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        spark.catalog.clearCache()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(directory).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
