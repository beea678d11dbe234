"""A batched, retrying write to a key-value store, run on the executors.

The store is reached through a client object, made anew in every task. A client
replaces the stored item of a key, so that a repeated batch (a retry, a lost
executor, a speculative task) changes nothing.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tripmill.fixed_values import (
    BATCH_ROWS,
    WRITE_BACKOFF,
    WRITE_DELAY_SECONDS,
    WRITE_TRIES,
)
from tripmill.functions.numbers import batch_number
from tripmill.functions.text import column


class StoreClient(Protocol):
    """What the sink needs from a store."""

    # errors worth another try
    transient: tuple[type[Exception], ...]

    def open(self, partition: int) -> None: ...

    def put(self, items: pa.RecordBatch) -> None:
        """Store the items, at most one batch; existing keys are replaced."""

    def close(self) -> None:
        """All items of the partition have been put. Called again after a transient error."""

    def report(self, reports: list[PartitionReport]) -> None:
        """Called once, on the driver's side, after every partition is written."""


# A client may also have ``discard()``, called in a task that fails, and ``abort(reports)``,
# called on the driver's side when the write has failed.
ClientFactory = Callable[[dict[str, str]], StoreClient]


@dataclass
class PartitionReport(WriterCommitMessage):
    partition: int
    rows: int
    batches: int
    retries: int


def cut_batches(
    stream: Iterator[pa.RecordBatch], size: int, number: str | None = None
) -> Iterator[pa.RecordBatch]:
    """Regroup a stream into batches of at most ``size`` rows.

    With ``number``, the column of consecutive row numbers, the cuts fall where
    they fall in the whole table (after row 300, 600, ...), not counted from the
    first row of the partition.
    """
    held: list[pa.RecordBatch] = []
    held_rows = 0
    held_group = None

    def release() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.concat_batches(held)

    for arrived in stream:
        rows = arrived.num_rows
        if rows == 0:
            continue
        if number is None:
            edges = range(size - held_rows, rows, size)
            groups = None
        else:
            groups = (arrived.column(number).to_numpy(zero_copy_only=False) - 1) // size
            edges = np.flatnonzero(np.diff(groups)) + 1
            if held and groups[0] != held_group:
                yield release()
                held, held_rows = [], 0
        start = 0
        for edge in [*edges, rows]:
            edge = int(edge)
            held.append(arrived.slice(start, edge - start))
            held_rows += edge - start
            start = edge
            if edge < rows or (number is None and held_rows == size):
                yield release()
                held, held_rows = [], 0
        held_group = None if groups is None else groups[-1]
    if held:
        yield release()


def with_retry(
    action: Callable[[], None],
    transient: tuple[type[Exception], ...],
    tries: int,
    delay: float,
    backoff: float,
    sleep: Callable[[float], None] = time.sleep,
) -> int:
    """Run the action, again after a transient error; returns the number of retries."""
    for retry in range(tries):
        try:
            action()
            return retry
        except transient:
            if retry == tries - 1:
                raise
            sleep(delay * backoff**retry)
    raise ValueError("tries must be at least 1")


class _KeyedWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], keys: Sequence[str], make_client: ClientFactory):
        self.options = options
        self.keys = keys
        self.make_client = make_client

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartitionReport:
        options = self.options
        size = int(options.get("batchrows", BATCH_ROWS))
        tries = int(options.get("tries", WRITE_TRIES))
        delay = float(options.get("delayseconds", WRITE_DELAY_SECONDS))
        backoff = float(options.get("backoff", WRITE_BACKOFF))
        # At most this many batches per second and partition; 0 is no limit.
        rate = float(options.get("batchespersecond", 0))

        client = self.make_client(options)
        report = PartitionReport(TaskContext.get().partitionId(), 0, 0, 0)
        closed = False

        def retried(action: Callable[[], None]) -> None:
            report.retries += with_retry(action, client.transient, tries, delay, backoff)

        try:
            client.open(report.partition)
            for items in cut_batches(iterator, size, options.get("numbercolumn")):
                began = time.monotonic()
                self.check_keys(items)
                retried(lambda items=items: client.put(items))
                report.rows += items.num_rows
                report.batches += 1
                if rate:
                    time.sleep(max(0.0, 1 / rate - (time.monotonic() - began)))
            retried(client.close)
            closed = True
        finally:
            if not closed and hasattr(client, "discard"):
                client.discard()
        return report

    def check_keys(self, items: pa.RecordBatch) -> None:
        for key in self.keys:
            if items.column(key).null_count:
                raise ValueError(f"the key column {key} holds a null")

    def abort(self, messages: list[PartitionReport | None]) -> None:
        client = self.make_client(self.options)
        if hasattr(client, "abort"):
            client.abort([m for m in messages if m is not None])

    def commit(self, messages: list[PartitionReport | None]) -> None:
        self.make_client(self.options).report([m for m in messages if m is not None])


def register_keyed_sink(spark: SparkSession, name: str, make_client: ClientFactory) -> None:
    """Make ``df.write.format(name).mode("append")`` write through the client.

    ``make_client`` gets the write options, whose names are in lower case.
    """

    class KeyedSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            if overwrite:
                raise ValueError("a keyed sink replaces items by key: use mode('append')")
            if "keys" not in self.options:
                raise ValueError("name the key columns in the option 'keys'")
            keys = self.options["keys"].split(",")
            if missing := set(keys) - set(schema.names):
                raise ValueError(f"no such key columns: {sorted(missing)}")
            return _KeyedWriter({k.lower(): v for k, v in self.options.items()}, keys, make_client)

    # The classes travel by value: executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules["tripmill"])
    spark.dataSource.register(KeyedSink)


def dealt_by_batch(
    df: DataFrame, number: str, batch_rows: int = BATCH_ROWS, tasks: int | None = None
) -> DataFrame:
    """Whole batches of consecutive row numbers to a task each, in the order of the numbers.

    Batch 1 is rows 1 to ``batch_rows``, and so on. They are dealt in turn to ``tasks`` tasks (by
    default the session's number of shuffle partitions), so that no batch is cut by the edge of a task.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    batch = batch_number(column(number), batch_rows)
    dealt = df.repartitionById(tasks, F.pmod(batch, F.lit(tasks)).cast("int"))
    return dealt.sortWithinPartitions(column(number))


def batches_to_put(dealt: DataFrame, number: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``n_rows``, ``first_row`` and ``last_row`` of each batch that the writer cuts from a frame."""
    cloudpickle.register_pickle_by_value(sys.modules["tripmill"])

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_batches(stream, batch_rows, number):
            numbers = batch.column(number)
            columns = [[batch.num_rows], [numbers[0].as_py()], [numbers[-1].as_py()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n_rows", "first_row", "last_row"])

    return dealt.select(column(number)).mapInArrow(cut, "n_rows bigint, first_row bigint, last_row bigint")


def write_keyed(
    df: DataFrame,
    sink: str,
    keys: Sequence[str],
    batch_rows: int = BATCH_ROWS,
    number: str | None = None,
    tasks: int | None = None,
    **options: str | int | float,
) -> None:
    """Write every row once to a registered sink, all partitions at the same time.

    With ``number``, the column of row numbers 1..N, the rows are put in exactly ceil(N /
    ``batch_rows``) batches, see ``dealt_by_batch``. Rows of one key may be put in any order:
    reduce the frame with ``latest_by_key`` first if it repeats keys.
    """
    if number is not None:
        df = dealt_by_batch(df, number, batch_rows, tasks)
    writer = df.write.format(sink).option("keys", ",".join(keys)).option("batchRows", batch_rows)
    if number is not None:
        writer = writer.option("numberColumn", number)
    writer.options(**options).mode("append").save()
