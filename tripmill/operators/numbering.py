"""Consecutive numbers in a global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.fixed_values import TRIP_DIGITS, TRIP_PREFIX
from tripmill.functions.numbers import sequence_key
from tripmill.functions.text import column
from tripmill.functions.time import time_key
from tripmill.session import new_folder

_RUN = "__run"
_POSITION = "__position"
_SHIFT = "__shift"


@contextmanager
def kept_in_between(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """A frame that is persisted for the work inside and given up after it, also if that fails."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def number_rows(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row_number",
    path: str | None = None,
    partitions: int | None = None,
    persist: StorageLevel | None = None,
) -> DataFrame:
    """Number all rows 1..N by ``order_by``, whose columns together are unique.

    The rows are range-partitioned and sorted, each one gets its position within
    its range, and the result is written to ``path`` (by default a new folder
    under the shared folder). Reading it back, the position plus the number of
    rows in all lower ranges is the row number.

    * Ranges are cut on all of ``order_by``: as its last column is unique, a
      time that a third of all rows share is cut into many ranges.
    * The cut points are sampled, so another run may cut elsewhere. The written
      table fixes them: counts, batches and retries all see the same numbers.
    * ``partitions`` is the number of ranges; without it the session's number of
      shuffle partitions holds, which adaptive execution merges where they are
      small. Counting the ranges takes one row for each in one task.
    * Spark evaluates ``df`` twice, for the sample and for the shuffle;
      ``persist`` keeps it in between, for inputs that are costly to parse.

    This runs a job. Whoever owns ``path`` removes it once it is not needed.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, "numbered")
    keys = [column(c) for c in order_by]
    target = [] if partitions is None else [partitions]

    with kept_in_between(df, persist) if persist is not None else nullcontext(df) as source:
        ranges = (
            source.repartitionByRange(*target, *keys)
            .sortWithinPartitions(*keys)
            .withColumns({_RUN: F.spark_partition_id(), _POSITION: F.monotonically_increasing_id()})
        )
        ranges.write.parquet(path)

    stored = spark.read.schema(ranges.schema).parquet(path)
    # One row per range, so never more than there are partitions, whatever the
    # data: one task can add it up, and it can be broadcast.
    runs = stored.groupBy(_RUN).agg(
        F.count("*").alias("rows"), F.min(_POSITION).alias("first")
    )
    lower = F.sum("rows").over(Window.orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select(
        _RUN, (F.coalesce(lower, F.lit(0)) + 1 - F.col("first")).alias(_SHIFT)
    )
    return stored.join(F.broadcast(shifts), _RUN).select(
        *[column(c) for c in df.columns if c != name], (F.col(_POSITION) + F.col(_SHIFT)).alias(name)
    )


def with_trip_keys(
    numbered: DataFrame,
    start: str = "started_at",
    number: str = "row_number",
    key: str = "trip_id",
    sort_key: str | None = "started_at_timestamp",
    prefix: str = TRIP_PREFIX,
    digits: int = TRIP_DIGITS,
) -> DataFrame:
    """Add the sequence key and, unless ``sort_key`` is None, the time key."""
    added = {key: sequence_key(column(number), prefix, digits)}
    if sort_key is not None:
        added[sort_key] = time_key(numbered, start)
    return numbered.withColumns(added)


def row_range(numbered: DataFrame, first: int, last: int, number: str = "row_number") -> DataFrame:
    return numbered.filter(column(number).between(first, last))
