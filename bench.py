"""Time the headline queries and print one JSON line.

Every query writes its whole result to the no-op sink, so no column is pruned.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from rowloom.plans.table_queries import QUERIES

HEADLINE = (
    "normalize_customer", "normalize_orders_multivalue", "normalize_lineitem_subvalue",
    "normalize_part_localref", "events_incremental", "text_escaping", "markup_in_records",
    "multi_app_union", "profile", "pivot_wide", "catalog_precedence", "target_precedence",
    "well_formedness", "record_counts", "package_run", "events_stream",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small run first, so that the first query does not pay for JVM start-up.
    QUERIES["normalize_customer"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
