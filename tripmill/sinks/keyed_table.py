"""A keyed table of Parquet files: every write adds a folder, the last write of a key counts.

A log beside the folders says which of them count and in which order. An entry is created when its
folder is complete and takes the next number, so that neither a lost job nor a clock has
a say. A compaction writes the items there are, one to a key, in buckets of the key, and is a log
entry as well: from then on a read takes it and the writes behind it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripmill import storage
from tripmill.functions.text import any_of, column
from tripmill.operators.upsert import latest_by_key

_LOG = "_log"
_FOLDER = "__write"  # the partition column of the writes' folders
_BUCKET = "__bucket"
_ORDER = "__order"
BUCKET_BYTES = 128 << 20


@dataclass(frozen=True)
class _Entry:
    number: int
    kind: str
    folder: str
    rows: int
    size: int
    schema: StructType
    through: int = -1
    buckets: int = 0


def write_items(
    items: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str] = (), write: int | None = None
) -> int:
    """Add a write of whole items below ``path`` (any Hadoop URI); returns its number in the log.

    The write counts from the moment its log entry is there, and as a whole. Its number is the
    next one, or ``write`` if that is free. A null key raises. ``order_by`` settles which of
    several items of a key in this write is the last; without it ``items`` holds a key once.
    """
    spark = items.sparkSession
    items = latest_by_key(items, keys, order_by) if order_by else items
    missing = any_of(column(k).isNull() for k in keys)
    first, *rest = items.columns
    checked = F.when(missing, F.raise_error(F.lit("a key is null"))).otherwise(column(first))
    # The check keeps the column's own nullability, so that all writes have one schema.
    entry = _stored(items.select(checked.alias(first), *map(column, rest)), path, f"{_FOLDER}=w-{uuid.uuid4().hex}")
    return _publish(spark, path, {"kind": "write", **entry}, write)


def read_items(
    spark: SparkSession, path: str, keys: Sequence[str], wanted: Sequence[tuple] | None = None
) -> DataFrame:
    """Per key the item that was written last, with the columns of all writes.

    ``wanted`` are the keys to read, in the order of ``keys``, if not all: of a compacted table
    only their buckets are opened, and in these the files' key ranges and Bloom filters hold.
    The items of newer writes are reduced to one a key; those of the compaction are so already
    and only leave out the keys of newer ones.
    """
    base, writes = _live(spark, path)
    chosen = F.lit(True) if wanted is None else any_of(_same(keys, values) for values in wanted)
    schema = _merged([e.schema for e in ([base] if base else []) + writes])
    newest = None
    if writes:
        numbers = F.create_map(*(F.lit(x) for e in writes for x in (e.folder.split("=")[1], e.number)))
        stored = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{e.folder}" for e in writes))
        newest = stored.withColumn(_ORDER, F.element_at(numbers, F.col(_FOLDER))).drop(_FOLDER).where(chosen)
        newest = latest_by_key(newest, keys, [_ORDER]).drop(_ORDER)
    if base is None:
        return newest
    kept = spark.read.schema(schema).parquet(f"{path}/{base.folder}")
    if wanted is not None:
        kept = kept.where(any_of(_in_bucket(base, keys, values) for values in wanted)).where(chosen)
    kept = kept.drop(_BUCKET)
    if newest is None:
        return kept
    replaced = newest.select(*[column(k).alias(f"__{i}") for i, k in enumerate(keys)])
    same = [column(k) == F.col(f"__{i}") for i, k in enumerate(keys)]
    return kept.join(replaced, same, "left_anti").unionByName(newest)


def compact(spark: SparkSession, path: str, keys: Sequence[str], bucket_bytes: int = BUCKET_BYTES) -> int:
    """Write the items there are, one to a key, as a new base; returns the number of its log entry.

    A bucket is one file, sorted by the key and with Bloom filters on it. Until the entry is there,
    and if the job is lost before, all reads take the old state. Writes that end in the
    meantime are newer than the base. The old folders stay until ``remove_old``.
    """
    base, writes = _live(spark, path)
    through = max([e.number for e in writes], default=base.through if base else -1)
    size = sum(e.size for e in ([base] if base else []) + writes)
    buckets = max(1, -(-size // bucket_bytes))
    items = read_items(spark, path, keys)
    named = items.withColumn(_BUCKET, _bucket_of([column(k).cast(items.schema[k].dataType) for k in keys], buckets))
    sorted_ = named.repartitionById(buckets, F.col(_BUCKET)).sortWithinPartitions(_BUCKET, *map(column, keys))
    bloom = {f"parquet.bloom.filter.enabled#{k}": "true" for k in keys}
    entry = _stored(sorted_, path, f"base-{uuid.uuid4().hex}", _BUCKET, bloom)
    return _publish(spark, path, {"kind": "base", **entry, "through": through, "buckets": buckets})


def remove_old(spark: SparkSession, path: str) -> None:
    """Remove folders that no read takes any more; those of writes that have not ended go as well."""
    base, writes = _live(spark, path)
    live = {e.folder for e in ([base] if base else []) + writes}
    for entry in storage.entries(spark, path):
        if entry.is_folder and entry.name != _LOG and entry.name not in live:
            storage.remove(spark, f"{path}/{entry.name}")


def write_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``put_order`` and ``n_rows`` of each write, counted while it was written."""
    rows = [(e.number, e.rows) for e in map(_entry(spark, path), _names(spark, path)) if e.kind == "write"]
    return spark.createDataFrame(rows, "put_order bigint, n_rows bigint")


def _same(keys: Sequence[str], values: tuple) -> Column:
    terms = [column(k) == F.lit(v) for k, v in zip(keys, values, strict=True)]
    found = terms[0]
    for term in terms[1:]:
        found = found & term
    return found


def _bucket_of(keys: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _in_bucket(base: _Entry, keys: Sequence[str], values: tuple) -> Column:
    """The values as the keys' own types, for a hash depends on the type."""
    typed = [F.lit(v).cast(base.schema[k].dataType) for k, v in zip(keys, values, strict=True)]
    return F.col(_BUCKET) == _bucket_of(typed, base.buckets)


def _stored(
    rows: DataFrame, path: str, folder: str, by: str | None = None, options: dict[str, str] | None = None
) -> dict:
    """Write the rows to a folder of their own; what a log entry says of them."""
    counted = Observation()
    writer = rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.options(**(options or {}))
    (writer.partitionBy(by) if by else writer).parquet(f"{path}/{folder}")
    return {
        "folder": folder,
        "rows": counted.get["rows"],
        "size": _size(rows.sparkSession, f"{path}/{folder}"),
        "schema": (rows.drop(by) if by else rows).schema.jsonValue(),
    }


def _size(spark: SparkSession, folder: str) -> int:
    return sum(_size(spark, f"{folder}/{e.name}") if e.is_folder else e.size for e in storage.entries(spark, folder))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Log entries, oldest first."""
    return [e.name for e in storage.entries(spark, f"{path}/{_LOG}") if e.name.endswith(".json") and e.name[0] != "."]


def _publish(spark: SparkSession, path: str, entry: dict, number: int | None = None) -> int:
    """Create the log entry under the next free number, or under the given one."""
    while True:
        last = max([int(n.split(".")[0]) for n in _names(spark, path)], default=-1)
        at = last + 1 if number is None else number
        if storage.create(spark, f"{path}/{_LOG}/{at:020d}.{entry['kind']}.json", json.dumps(entry)):
            return at
        if number is not None:
            raise ValueError(f"{path} has a write {number} already")


def _entry(spark: SparkSession, path: str):
    def read(name: str) -> _Entry:
        values = json.loads(storage.read_text(spark, f"{path}/{_LOG}/{name}"))
        schema = StructType.fromJson(values.pop("schema"))
        return _Entry(number=int(name.split(".")[0]), schema=schema, **values)

    return read


def _live(spark: SparkSession, path: str) -> tuple[_Entry | None, list[_Entry]]:
    """The last base, and the writes that it does not have; older entries are not read."""
    names, read = _names(spark, path), _entry(spark, path)
    bases = [n for n in names if n.endswith(".base.json")]
    base = read(bases[-1]) if bases else None
    through = base.through if base else -1
    newer = [n for n in names if n.endswith(".write.json") and int(n.split(".")[0]) > through]
    if base is None and not newer:
        raise ValueError(f"there is no keyed table at {path}")
    return base, [read(n) for n in newer]


def _merged(schemas: Sequence[StructType]) -> StructType:
    """The columns of all schemas, in the order in which they were first written."""
    fields: dict[str, object] = {}
    for schema in schemas:
        for field in schema.fields:
            if fields.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"{field.name} was written as {fields[field.name].simpleString()} and {field.dataType.simpleString()}")
    merged = StructType()
    for name, kind in fields.items():
        merged = merged.add(name, kind)
    return merged
