"""Wall time of the headline queries; prints one JSON line.

Every query is run in full (all rows computed, none sent to the driver):
once to warm up, then BENCH_RUNS times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from jornada.catalogue import QUERIES

HEADLINE = [
    "mart_time_entries",
    "mart_worked_hours",
    "pipe_employees",
    "pipe_time_entries",
    "pipe_worked_hours",
    "pipe_time_charges",
    "pipe_signings",
    "pipe_assignments",
    "daily_worked_hours",
    "worked_hours_with_checks",
    "upsert_single_key",
    "upsert_composite_key",
    "classify_changes",
    "append_new",
    "anti_null_safe",
    "delete_by_key",
    "latest_per_key",
    "latest_max_by",
    "join_left_project",
    "join_left_employee",
    "join_latest_assignment",
    "lookup_contains",
    "lookup_contains_substrings",
    "board_cells_pivot",
    "apply_cell_edits",
    "scan_date_range",
    "listing_page",
    "parse_dayfirst",
    "parse_utc",
    "rtrim_ws",
    "csv_roundtrip",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        measured = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(measured[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
