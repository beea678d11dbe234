"""A store client for tests: it keeps what it is given as Parquet files, one for each partition."""

from __future__ import annotations

import json
import sys
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.upsert import latest_by_key
from tripmill.sinks.keyed import PartitionReport, register_keyed_sink

SINK_NAME = "file_store"
_ROWS_PER_GROUP = 65536
_WRITE = "put_order"


class FileStore:
    transient = (OSError,)

    def __init__(self, options: dict[str, str]):
        uri = options["path"]
        if "://" in uri:
            self.files, root = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        else:
            self.files, root = fs.LocalFileSystem(), uri.removeprefix("file:")
        # one folder per write; as a number it also orders the writes
        self.folder = f"{root}/{_WRITE}={options['writenumber']}"

    def open(self, partition: int) -> None:
        self.files.create_dir(self.folder)
        self.name = f"part-{partition:06d}.parquet"
        self.draft = f"{self.folder}/_{uuid.uuid4().hex}-{self.name}"
        self.writer = None
        self.held: list[pa.RecordBatch] = []
        self.held_rows = 0

    def put(self, items: pa.RecordBatch) -> None:
        if self.held_rows >= _ROWS_PER_GROUP:
            self._flush()  # before the items are held: a put that is tried again holds them once
        self.held.append(items)
        self.held_rows += items.num_rows

    def close(self) -> None:
        self._flush()
        if self.writer is not None:
            self.writer.close()
            self.files.move(self.draft, f"{self.folder}/{self.name}")

    def report(self, reports: list[PartitionReport]) -> None:
        self.files.create_dir(self.folder)
        total = {
            "partitions": len(reports),
            "rows": sum(r.rows for r in reports),
            "batches": sum(r.batches for r in reports),
            "retries": sum(r.retries for r in reports),
        }
        with self.files.open_output_stream(f"{self.folder}/_report.json") as out:
            out.write(json.dumps(total).encode())

    def read_report(self) -> dict[str, int]:
        with self.files.open_input_stream(f"{self.folder}/_report.json") as file:
            return json.loads(file.read())

    def _flush(self) -> None:
        if not self.held:
            return
        table = pa.Table.from_batches(self.held)
        if self.writer is None:
            self.writer = pq.ParquetWriter(self.draft, table.schema, filesystem=self.files)
        self.writer.write_table(table)
        self.held, self.held_rows = [], 0


def register_file_store(spark: SparkSession) -> None:
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    register_keyed_sink(spark, SINK_NAME, FileStore)


def next_write() -> int:
    return time.time_ns()


def write_report(path: str, write_number: int) -> dict[str, int]:
    """Partitions, rows, batches and retries of a finished write."""
    return FileStore({"path": path, "writenumber": str(write_number)}).read_report()


def read_store(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The stored items: per key the one that was put last."""
    puts = spark.read.parquet(path).withColumn(_WRITE, F.col(_WRITE).cast("bigint"))
    return latest_by_key(puts, keys, [_WRITE]).drop(_WRITE)
