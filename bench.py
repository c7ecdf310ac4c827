"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "occupancy_grid",
    "occupancy_grid_keyed",
    "event_occupancy",
    "wide_frame",
    "wide_frame_keyed",
    "supervised_long",
    "target_audit",
    "exact_features_one",
    "exact_features_batch",
    "prediction_eligibility",
    "validation_stats",
    "quality_summary",
    "duplicate_pairs",
    "dwell_stats",
    "dwell_by_category",
    "daily_detail",
    "daily_state",
    "acf_at_horizons",
    "acf_full",
    "pacf",
    "baseline_hourly_mean",
    "baseline_previous_day",
    "parse_events",
    "gbt_metrics",
]


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    from dwellgrid.plans import catalog

    registered = catalog.queries()
    # One pass over the table first, so that start-up is not charged to the first query.
    catalog.visits_scan(spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall-clock",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
