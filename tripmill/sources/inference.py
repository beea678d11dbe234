"""Types of CSV columns, inferred from all values of all files in one scan.

A value fits some of the types below, as the bits of a number say; a group of values fits those that each
of them fits, so groups are merged by a bitwise AND: tasks, files and the whole table alike. The type
is the first that is left. Read file by file, a column can be a number in one file and
text in another; here it has one type, and the files that would have had another are named.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from tripmill.functions.text import column, quoted

#: In the order in which they are tried; a value that fits none is text.
TYPES = ("int", "bigint", "double", "boolean", "date", "timestamp_ntz")
_BIT = {name: 1 << k for k, name in enumerate(TYPES)}
_WHOLE = r"^(0|-?[1-9][0-9]*)$"
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
#: Beyond this a double no longer holds every whole number.
_EXACT = 1 << 53


def type_bits(text: Column) -> Column:
    """The types that a text fits without a loss; null for a null.

    A number with a leading zero or a plus is text, as its digits would not come back, and so is,
    among fractions, a whole number that a double rounds. Dates fit times as well.
    """

    def bit(name: str, fits: Column) -> Column:
        return F.when(fits, F.lit(_BIT[name])).otherwise(F.lit(0))

    whole = (
        bit("int", text.try_cast("int").isNotNull())
        .bitwiseOR(bit("bigint", text.try_cast("bigint").isNotNull()))
        .bitwiseOR(bit("double", F.abs(text.try_cast("decimal(38,0)")) <= _EXACT))
    )
    day = bit("date", text.try_cast("date").isNotNull())
    time = bit("timestamp_ntz", text.try_cast("timestamp_ntz").isNotNull())
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(text.rlike(_WHOLE), whole)
        .when(text.rlike(_NUMBER), bit("double", F.abs(text.try_cast("double")) < float("inf")))
        .when(text.rlike(_DATE), day.bitwiseOR(time))
        .when(text.rlike(_TIME), time)
        .when(F.lower(text).isin("true", "false"), F.lit(_BIT["boolean"]))
        .otherwise(F.lit(0))
    )


def type_name(bits: Column) -> Column:
    """The type of a group of values; null if it had none."""
    name = F.when(bits.isNull(), F.lit(None).cast("string"))
    for kind, bit in _BIT.items():
        name = name.when(bits.bitwiseAND(F.lit(bit)) != 0, kind)
    return name.otherwise("string")


def read_text(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """All files in one scan, every column as text under the first file's header.

    A file whose header differs, or a row of another length, fails the job.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = spark.read.options(**options).csv(paths, header=True).columns
    schema = StructType([StructField(name, StringType()) for name in names])
    return spark.read.options(**options).option("mode", "FAILFAST").schema(schema).csv(paths, header=True, enforceSchema=False)


def file_types(text: DataFrame) -> DataFrame:
    """``file``, ``column_name``, ``n_values`` and ``bits`` for each file and column of :func:`read_text`."""
    counted = text.select("*", F.col("_metadata.file_path").alias("__file")).groupBy("__file")
    names = text.columns
    totals = counted.agg(
        *[F.count(column(c)).alias(f"__n{k}") for k, c in enumerate(names)],
        *[F.bit_and(type_bits(column(c))).alias(f"__b{k}") for k, c in enumerate(names)],
    )
    each = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"__n{k}").alias("n_values"), F.col(f"__b{k}").alias("bits"))
        for k, c in enumerate(names)
    ]
    return totals.select(F.col("__file").alias("file"), F.inline(F.array(*each)))


@dataclass(frozen=True)
class Inference:
    """One schema for all files, and the type that each file by itself would have had."""

    schema: StructType
    files: DataFrame

    @property
    def conflicts(self) -> DataFrame:
        """The files and columns whose own type is another one than the schema's."""
        return self.files.where("file_type <> data_type")


def infer_types(text: DataFrame, as_text: Sequence[str] = ()) -> Inference:
    """The types of a frame of texts by :func:`read_text`, in one job over it.

    ``as_text`` names columns that are text whatever they hold, such as ids. A column without a
    value is text. What comes to the driver is a row for each file and column.
    """
    spark = text.sparkSession
    found = file_types(text).withColumn("file_type", type_name(F.col("bits"))).collect()
    merged: dict[str, int | None] = dict.fromkeys(text.columns)
    for row in found:
        if row["bits"] is not None:
            before = merged[row["column_name"]]
            merged[row["column_name"]] = row["bits"] if before is None else before & row["bits"]
    kinds = {
        name: "string" if name in as_text or not bits else next(kind for kind in TYPES if bits & _BIT[kind])
        for name, bits in merged.items()
    }
    schema = StructType([StructField(name, _parse_datatype_string(kind)) for name, kind in kinds.items()])
    files = spark.createDataFrame(
        [(r["file"], r["column_name"], r["n_values"], r["file_type"], kinds[r["column_name"]]) for r in found],
        "file string, column_name string, n_values bigint, file_type string, data_type string",
    )
    return Inference(schema, files)


def read_inferred(
    spark: SparkSession, paths: str | Sequence[str], as_text: Sequence[str] = (), **options: str
) -> DataFrame:
    """CSV files under the one schema that all their values fit; a null stays a null.

    The values are cast from the text that was tested, so that none is read otherwise than it was
    inferred: two scans in all, of which the second reads the columns that are asked of it.
    """
    text = read_text(spark, paths, **options)
    schema = infer_types(text, as_text).schema
    return text.selectExpr(*[f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema])
