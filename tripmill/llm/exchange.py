"""Questions that blocks of documents ask of all documents, and the answers back to the blocks.

A block asks about keys (hashes or words), each once, in one packed binary for each bucket of
keys. A bucket's task sees what every block asks about its keys and sends each block
one packed answer, in the order of the question. So no key gathers more rows than there are blocks,
however often it occurs, and one bucket at a time is sorted in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import scratch_folder, small_batches

BLOCK_BYTES = 2 << 20
#: Packed bytes that one bucket is planned to hold.
BUCKET_BYTES = 12 << 20
ASKED = "bucket long, block long, question binary"


def blocks(docs: DataFrame, columns: list[str], text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block``, ``size`` and ``packed``: the rows in blocks of about that many bytes of text, one row at least.

    A block is an Arrow table of the columns and the text, compressed; it is written to the
    shared folder once, so that its number and row order stay, and it is small enough to be
    sent along with its answers.
    """
    chosen = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in small_batches(batches, "__text", block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as stream:
                stream.write_batch(batch)
            texts = batch.column(batch.num_columns - 1)
            size = sum(len(t.as_buffer()) for t in texts)
            packed = packer.compress(sink.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([size]), pa.array([packed], pa.binary())], names=["size", "packed"])

    return numbered(chosen.mapInArrow(run, "size long, packed binary"))


def numbered(packed: DataFrame) -> DataFrame:
    """Packed rows with their number, ``block``, written once and bucketed by it."""
    return _bucketed(packed.withColumn("block", F.monotonically_increasing_id()), "block")


def _bucketed(frame: DataFrame, key: str) -> DataFrame:
    """Write a table bucketed by its key, so that joins on it move the other side only.

    The files are in the shared folder; their name is dropped from the catalog again at once.
    """
    spark = frame.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"blocks_{uuid.uuid4().hex}"
    writer = frame.repartition(n, key).write.bucketBy(n, key).option("path", scratch_folder(spark, "blocks"))
    writer.saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def unpacked(packed: bytes) -> pa.RecordBatch:
    data = zstandard.ZstdDecompressor().decompress(packed)
    with pa.ipc.open_stream(data) as stream:
        return next(iter(stream))


def n_buckets(of: DataFrame, packed_per_byte: float) -> int:
    """Buckets for what blocks of this total size ask."""
    total = of.agg(F.sum("size")).first()[0] or 0
    return max(8, int(total * packed_per_byte / BUCKET_BYTES))


def answered(asked: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """``block`` and ``answers``: a block's (bucket, answer) pairs, for all buckets it asked."""

    def reply(group: pa.Table) -> pa.Table:
        found = answer([question.as_buffer() for question in group.column("question")])
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "answer": pa.array(found, pa.binary())})

    replies = asked.groupBy("bucket").applyInArrow(reply, "block long, bucket long, answer binary")
    return replies.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))


def with_answers(of: DataFrame, *rounds: DataFrame) -> DataFrame:
    """Blocks with a column ``round_k`` of answers for each round; null for a block that asked nothing."""
    for k, replies in enumerate(rounds):
        of = of.join(replies.withColumnRenamed("answers", f"round_{k}"), "block", "left")
    return of
