"""Inferred types: values, merging, files that disagree, one scan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripmill.sources.inference import file_types, infer_types, read_inferred, read_text, type_bits, type_name

VALUES = {
    "0": "int",
    "-7": "int",
    "2147483647": "int",
    "2147483648": "bigint",
    "-9223372036854775808": "bigint",
    "9223372036854775808": "string",
    "007": "string",
    "+7": "string",
    "-0": "double",
    "1.50": "double",
    "1e400": "string",
    "-2.5E-3": "double",
    "NaN": "string",
    "True": "boolean",
    "yes": "string",
    "2022-02-28": "date",
    "2022-02-30": "string",
    "2022-02-28 10:00:00": "timestamp_ntz",
    "2022-02-28T10:00:00.123456": "timestamp_ntz",
    "2022-02-28 25:00:00": "string",
    "28/02/2022": "string",
    " 7": "string",
    "": "string",
    None: None,
}


def test_types_of_single_values(spark):
    frame = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = {r.v: r.kind for r in frame.select("v", type_name(type_bits(F.col("v"))).alias("kind")).collect()}
    assert got == VALUES


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "2147483648"], "bigint"),
        (["1", "2.5"], "double"),
        (["9007199254740993", "2.5"], "string"),
        (["9007199254740993", "1"], "bigint"),
        (["2022-01-01", "2022-01-01 00:00:00"], "timestamp_ntz"),
        (["1", "true"], "string"),
        (["1", None], "int"),
        ([None, None], None),
        ([], None),
        (["13285", "chargingstx3"], "string"),
    ],
)
def test_types_of_groups(spark, values, kind):
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    assert frame.agg(type_name(F.bit_and(type_bits(F.col("v")))).alias("t")).first().t == kind


def write(folder, name, header, *rows):
    (folder / name).write_text("\n".join([header, *rows]) + "\n")
    return str(folder / name)


def test_files_that_disagree(spark, tmp_path, capsys):
    header = "id,`n`,when,empty"
    paths = [
        write(tmp_path, "a.csv", header, "13285,1,2022-01-01,", "13286,,2022-01-02,"),
        write(tmp_path, "b c.csv", header, "chargingstx3,2.5,2022-01-01 10:00:00,"),
        write(tmp_path, "d.csv", header),
    ]
    text = read_text(spark, paths)
    found = infer_types(text)
    assert [f.dataType.simpleString() for f in found.schema] == ["string", "double", "timestamp_ntz", "string"]
    conflicts = {(r.file.rsplit("/", 1)[1], r.column_name): (r.file_type, r.data_type) for r in found.conflicts.collect()}
    assert conflicts == {("a.csv", "id"): ("int", "string"), ("a.csv", "`n`"): ("int", "double"), ("a.csv", "when"): ("date", "timestamp_ntz")}
    read = read_inferred(spark, paths)
    rows = read.orderBy("id").collect()
    assert [(r[0], r[1], r[2].hour, r[3]) for r in rows] == [("13285", 1.0, 0, None), ("13286", None, 0, None), ("chargingstx3", 2.5, 10, None)]
    file_types(text).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan csv") == 1 and "partial_bit_and" in plan


def test_ids_by_name(spark, tmp_path):
    path = write(tmp_path, "a.csv", "id,n", "13285,1")
    assert [k for _, k in read_inferred(spark, path, as_text=["id"]).dtypes] == ["string", "int"]


def test_other_headers_and_short_rows_fail(spark, tmp_path):
    one, other = write(tmp_path, "a.csv", "id,n", "1,2"), write(tmp_path, "b.csv", "n,id", "1,2")
    with pytest.raises(Exception, match="(?i)header"):
        infer_types(read_text(spark, [one, other]))
    with pytest.raises(Exception, match="(?i)malformed"):
        infer_types(read_text(spark, write(tmp_path, "c.csv", "id,n", "1")))
