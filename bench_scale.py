"""Times the heavy steps on a multiple of the sf0.1 events.

    python bench_scale.py FOLDER [FACTOR]

FOLDER keeps the enlarged tables (made once, 270 MB per 10 million trips) and
FACTOR, 100 by default, is how many times the 100,000 events are repeated, each
time with new ids and 30 days later. Prints seconds, the best of three runs.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.operators.clean import clean_trips
from tripmill.operators.numbering import with_trip_keys
from tripmill.operators.upsert import latest_by_key
from tripmill.plans.derived_trips import derived_trips
from tripmill.plans.preparation import StorePlan, keyed_trips
from tripmill.session import build_session
from tripmill.sources.files import parquet_if_absent

EVENTS = "/root/testdata/sf0.1/events.parquet"


def main(folder: str, factor: int = 100) -> None:
    spark = build_session(
        "bench_scale",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "32",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def enlarged() -> DataFrame:
        copies = spark.range(0, factor, 1, 16).withColumnRenamed("id", "copy")
        return spark.read.parquet(EVENTS).hint("broadcast").join(copies).select(
            (F.col("copy") * 100_000 + F.col("event_id")).alias("event_id"),
            F.timestamp_add("DAY", (F.col("copy") * 30).cast("int"), F.col("ts")).alias("ts"),
            "user_id", "event_type", "value", "props",
        )

    events = parquet_if_absent(spark, f"{folder}/events.parquet", enlarged)
    trips = parquet_if_absent(
        spark, f"{folder}/trips.parquet", lambda: derived_trips(spark, folder)
    )
    hot = F.col("ride_id") % 3 == 0
    one_start = trips.withColumns(
        {
            "started_at": F.when(hot, F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'")).otherwise(
                F.col("started_at")
            ),
            "ended_at": F.when(hot, F.expr("TIMESTAMP_NTZ'2025-01-01 00:20:00'")).otherwise(
                F.col("ended_at")
            ),
        }
    )
    one_user = events.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id"))
    )

    def one_window() -> DataFrame:
        order = Window.orderBy("started_at", "ride_id")
        numbered = clean_trips(trips).withColumn("row_number", F.row_number().over(order))
        return with_trip_keys(numbered)

    def latest(df: DataFrame) -> DataFrame:
        return latest_by_key(df, ("user_id", "event_type"), ("event_id",))

    steps: dict[str, Callable[[], DataFrame]] = {
        "scan of all trip columns": lambda: trips,
        "clean_trips": lambda: clean_trips(trips),
        "keyed_trips": lambda: keyed_trips(trips),
        "keyed_trips, input persisted": lambda: keyed_trips(
            trips, StorePlan(persist=StorageLevel.MEMORY_AND_DISK)
        ),
        "one global window instead": one_window,
        "keyed_trips, a third at one start": lambda: keyed_trips(one_start),
        "latest_by_key": lambda: latest(events),
        "latest_by_key, a third for one user": lambda: latest(one_user),
    }
    print(f"{trips.count():,} trips")
    for name, step in steps.items():
        best = float("inf")
        for _ in range(3):
            began = time.perf_counter()
            step().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        print(f"{name:40s} {best:6.1f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], *map(int, sys.argv[2:]))
