"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from cellwright import plans

#: Latest snapshot, one cell's history, bucket means, alerts, overview, fleet health; then parse, join, reduce, reshape, noise.
HEADLINE = (
    "agg_latest_argmax", "topk_cell_history", "agg_time_bucket", "filter_threshold_latest", "agg_solar_overview", "agg_fleet_health",
    "topic_kv", "topic_patterns", "json_bad", "join_band", "join_asof_left", "win_runs", "cov_exact_narrow", "cov_epsilon_heartbeat",
    "null_fill", "coalesce_window", "pivot_merge_ts", "dq_zscore", "dq_delta_pct", "dq_sync_disk", "sink_partitioned",
)


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):  # the first run compiles code
            began = time.perf_counter()
            plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best or 1e9, time.perf_counter() - began)
        took[name] = round(best, 4)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
