"""Small helpers of the operators in this folder."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill import storage
from tripmill.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark reads.

    Python workers on this machine get the folder that this package was imported from.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_is(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32(key as text) leaves that remainder; a null key is never held out."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus == remainder, F.lit(False))


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are settled inside are removed at the end, when what was made of them is written.

    Without it they stay in the shared folder until its owner clears it.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for folder in _scratch.pop():
            storage.remove(spark, folder)


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one, which ends with the scratch that it is made in."""
    folder = new_folder(spark, label)
    if _scratch:
        _scratch[-1].append(folder)
    return folder


def settle(frame: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the table's
    real size, so that it broadcasts only what is below its threshold.
    """
    spark = frame.sparkSession
    folder = scratch_folder(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def free_name(frame: DataFrame, wanted: str) -> str:
    """A column name that clashes with none of the frame's, whatever their case."""
    taken = {name.lower() for name in frame.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def small_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of a text column, one row at least."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        start, size = 0, 0
        for at, value in enumerate(values):
            length = len(value.as_buffer()) if value.is_valid else 0
            if size and size + length > limit:
                yield batch.slice(start, at - start)
                start, size = at, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)


def uniform(key: Column) -> Column:
    """A repeatable number in [0, 1) for each key."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)


def tokenizer_file(name: str = "piece_bpe_32k.model") -> str:
    """Path of a public vocabulary; the folder is the environment's TOKENIZERS_DIR."""
    return os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), name)
