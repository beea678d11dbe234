"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names instead of the headline ones, or "all"

All queries run once to warm up, then each BENCH_RUNS times (default 3); the
median counts. A run covers everything: building the plan, the jobs it starts on the
way, and reading every row and column of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from tripmill.plans.queries import QUERIES
from tripmill.session import build_session

HEADLINE = (
    "clean_trips",
    "keyed_trips",
    "batches_300",
    "store_trips_read_back",
    "whitespace_rows",
    "null_counts",
    "step_counts",
    "short_rides",
    "word_test",
    "word_test_desc_top10",
    "upsert_result",
    "keyed_sink_read_back",
    "csv_round_trip",
    "union_months",
    "parquet_if_absent",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    for name in names:
        seconds(name)
    took = {
        name: round(statistics.median(seconds(name) for _ in range(runs)), 3) for name in names
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the median seconds per query",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
