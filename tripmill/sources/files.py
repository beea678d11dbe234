"""File sources. Any URI that Hadoop can open is accepted."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tripmill import storage
from tripmill.fixed_values import MONTH_FILE, MONTHS
from tripmill.functions.text import column

# Ids are always text: read alone, a month with digits-only ids would look numeric.
TRIP_SCHEMA = StructType(
    [
        StructField("ride_id", StringType()),
        StructField("rideable_type", StringType()),
        StructField("started_at", TimestampNTZType()),
        StructField("ended_at", TimestampNTZType()),
        StructField("start_station_name", StringType()),
        StructField("start_station_id", StringType()),
        StructField("end_station_name", StringType()),
        StructField("end_station_id", StringType()),
        StructField("start_lat", DoubleType()),
        StructField("start_lng", DoubleType()),
        StructField("end_lat", DoubleType()),
        StructField("end_lng", DoubleType()),
        StructField("member_casual", StringType()),
    ]
)


def month_paths(
    base: str,
    year: int,
    months: Sequence[str] = MONTHS,
    pattern: str = MONTH_FILE,
) -> list[str]:
    """Paths of the monthly files below a bucket, container or folder."""
    return [f"{base.rstrip('/')}/{pattern.format(year=year, month=m)}" for m in months]


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType = TRIP_SCHEMA,
    rejected: str | None = None,
    **options: str,
) -> DataFrame:
    """One scan over all files under one declared schema.

    A value that its column's type can't hold, or a row of another length, fails the
    job. With ``rejected``, such a row is kept with what could be read of it and its
    whole line in a text column of that name, which is null for every sound row:
    ``split_rejected`` tells them apart. ``enforceSchema`` is off so that a file whose
    header names other columns fails instead of being read by position.
    """
    reader = spark.read.options(**options)
    if rejected is None:
        reader = reader.option("mode", "FAILFAST")
    else:
        schema = StructType([*schema.fields, StructField(rejected, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", rejected)
    return reader.schema(schema).csv(
        [paths] if isinstance(paths, str) else list(paths), header=True, enforceSchema=False
    )


def split_rejected(read: DataFrame, rejected: str) -> tuple[DataFrame, DataFrame]:
    """The sound rows without that column, and the rejected lines."""
    mark = column(rejected)
    return read.filter(mark.isNull()).drop(rejected), read.filter(mark.isNotNull()).select(mark)


_ANY_SLASHES = r"^([A-Za-z][A-Za-z0-9+.-]*):/+"


def path_coverage(
    spark: SparkSession, paths: Sequence[str], schema: StructType = TRIP_SCHEMA, **options: str
) -> DataFrame:
    """What each asked path, such as those of ``month_paths``, holds, found in one scan of all of them.

    ``path``, ``state`` (``missing``, ``empty`` or ``read``), ``n_files``, ``n_rows``, ``n_rejected`` (rows
    that the schema can't hold) and ``n_values`` (values of the schema's columns that aren't
    null). A path may be a file or a folder. Where a path is missing, a plain read of all would fail.
    """
    mark, file = "__rejected", "__file"
    there = [path for path in dict.fromkeys(paths) if storage.exists(spark, path)]
    asked = spark.createDataFrame([(path, path in there) for path in dict.fromkeys(paths)], "path string, there boolean")
    if not there:
        found = spark.createDataFrame([], "path string, n_files bigint, n_rows bigint, n_rejected bigint, n_values bigint")
    else:
        name = F.regexp_replace(F.col("_metadata.file_path"), _ANY_SLASHES, "$1:/")
        read = read_csv(spark, there, schema, rejected=mark, **options).withColumn(file, name)
        of = F.lit(None).cast("string")
        for path in there:
            whole = re.sub(_ANY_SLASHES, r"\1:/", storage.qualified(spark, path))
            of = F.when((F.col(file) == whole) | F.col(file).startswith(f"{whole.rstrip('/')}/"), path).otherwise(of)
        values = sum((column(c).isNotNull().cast("bigint") for c in schema.names), F.lit(0))
        found = read.groupBy(of.alias("path")).agg(
            F.count_distinct(file).alias("n_files"),
            F.count("*").alias("n_rows"),
            F.count_if(column(mark).isNotNull()).alias("n_rejected"),
            F.sum(values).alias("n_values"),
        )
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_files", "n_rows", "n_rejected", "n_values")]
    state = F.when(~F.col("there"), "missing").when(F.col("n_rows").isNull(), "empty").otherwise("read")
    return asked.join(found, "path", "left").select("path", state.alias("state"), *counts)


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position under the first frame's names and types.

    Casting first keeps a text column text where one frame holds it as a number;
    left to the union, the common type would be the number.
    """
    if not frames:
        raise ValueError("there is no frame to take the columns from")
    target = frames[0].schema.fields

    def conform(frame: DataFrame) -> DataFrame:
        if len(frame.columns) != len(target):
            raise ValueError(f"expected {len(target)} columns, got {frame.columns}")
        return frame.select(
            *[column(c).cast(f.dataType).alias(f.name) for c, f in zip(frame.columns, target)]
        )

    return reduce(DataFrame.union, [frames[0], *map(conform, frames[1:])])
