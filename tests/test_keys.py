"""Numbering, keys, batches and store text."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from tripmill.functions.numbers import decimal_text, sequence_key
from tripmill.functions.time import time_key, time_text
from tripmill.operators import numbering
from tripmill.operators.numbering import number_rows, row_range, with_trip_keys
from tripmill.operators.store_form import batch_summary, values_as_text, with_batch


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def by_one_window(df, *order):
    return df.withColumn("row_number", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def test_numbers_equal_one_global_window(spark):
    """Many orders share a date."""
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    numbered = number_rows(orders, ("o_orderdate", "o_orderkey"), partitions=7)
    assert numbered.columns == [*orders.columns, "row_number"]
    assert same_rows(numbered, by_one_window(orders, "o_orderdate", "o_orderkey"))


def test_numbers_stay_the_same_when_read_again(spark):
    df = spark.range(5000).withColumn("t", F.col("id") % 3)
    numbered = number_rows(df, ("t", "id"), partitions=5)
    first = {r.id: r.row_number for r in numbered.collect()}
    assert first == {r.id: r.row_number for r in numbered.filter("id >= 0").collect()}
    assert sorted(first.values()) == list(range(1, 5001))


def test_a_time_shared_by_a_third_of_the_rows_is_split(spark, tmp_path):
    """No range may hold much more than its share."""
    rows = spark.range(200_000, numPartitions=8).withColumn(
        "t", F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000)
    )
    path = str(tmp_path / "numbered")
    numbered = number_rows(rows, ("t", "id"), path=path, partitions=20)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("__run").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 200_000 / 20
    assert same_rows(numbered, by_one_window(rows, "t", "id"))


def test_only_the_table_of_ranges_goes_through_one_task(spark, capsys):
    numbered = number_rows(spark.range(1000), ("id",), partitions=4)
    numbered.explain("formatted")
    plan = capsys.readouterr().out
    assert plan.count("Exchange SinglePartition") <= 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_numbering_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert number_rows(empty, ("a", "b")).collect() == []
    df = spark.createDataFrame([(None, 1), (2, 2), (None, 3)], "a int, b int")
    numbered = {r.b: r.row_number for r in number_rows(df, ("a", "b"), partitions=3).collect()}
    assert numbered == {1: 1, 3: 2, 2: 3}


def test_numbering_releases_what_it_persists(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    numbered = number_rows(df, ("id",), persist=StorageLevel.MEMORY_AND_DISK)
    assert numbered.count() == 100
    assert not df.is_cached


def test_row_range(spark):
    numbered = number_rows(spark.range(1000), ("id",))
    assert [r.id for r in row_range(numbered, 301, 303).orderBy("id").collect()] == [300, 301, 302]


def test_sequence_key_pads_but_never_cuts(spark):
    df = spark.createDataFrame([(1,), (9_999_999,), (12_345_678,)], "n bigint")
    keys = [r[0] for r in df.orderBy("n").select(sequence_key(F.col("n"), "TRIP_", 7)).collect()]
    assert keys == ["TRIP_0000001", "TRIP_9999999", "TRIP_12345678"]


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago"])
def test_time_text_of_zoneless_times_ignores_the_session_zone(spark, zone):
    """02:30 does not exist on that day in Chicago."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT timestamp_ntz'2022-03-13 02:30:07.9' AS t")
        assert df.select(time_key(df, "t")).first()[0] == "20220313023007"
        assert df.select(time_text(df, "t")).first()[0] == "2022-03-13 02:30:07"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_time_text_of_zoned_times(spark):
    df = spark.sql("SELECT timestamp'2022-03-13 02:30:07.9' AS t")
    assert df.select(time_key(df, "t"), time_text(df, "t")).first()[:] == (
        "20220313023007",
        "2022-03-13 02:30:07",
    )


def test_keys_with_and_without_sort_key(spark):
    df = spark.sql("SELECT timestamp_ntz'2022-01-02 03:04:05' AS started_at, 7L AS row_number")
    row = with_trip_keys(df).first()
    assert (row.trip_id, row.started_at_timestamp) == ("TRIP_0000007", "20220102030405")
    assert with_trip_keys(df, key="id", sort_key=None).columns[-1] == "id"


def test_decimal_text_equals_decimal_notation(spark):
    draw = random.Random(7)
    values = [
        0.0, -0.0, 1.0, -87.65, 41.881832, 1e-3, 1e-5, -1.5e-5, 1.234567e-6, 9.9e-7, 1e-7,
        1.2345e-10, 1e7, 1e8, 123456789.5, -1e15, 9.007199254740991e15, 1e16, 1.5e16, -2.5e20,
        *[round(draw.uniform(-180, 180), 6) for _ in range(500)],
        *[round(draw.uniform(0, 1e-4), 9) for _ in range(200)],
        *[round(draw.uniform(1e7, 1e12), 2) for _ in range(200)],
    ]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", decimal_text(F.col("v")).alias("t")).collect():
        assert row.t == str(Decimal(str(row.v)))


def test_decimal_text_of_null_and_float(spark):
    df = spark.sql("SELECT CAST(NULL AS DOUBLE) AS a, CAST(0.1 AS FLOAT) AS b, 5 AS c")
    row = df.select(*[decimal_text(F.col(c)) for c in "abc"]).first()
    assert row[0] is None
    assert row[1] == "0.10000000149011612"


def test_values_as_text_types(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2022-01-01 00:00:00' AS started_at, 1.5D AS start_lat, 1 AS other"
    )
    text = values_as_text(df, ("started_at",), ("start_lat",))
    assert text.dtypes == [("started_at", "string"), ("start_lat", "string"), ("other", "int")]


def test_batches_are_consecutive_and_the_last_may_be_short(spark):
    numbered = number_rows(spark.range(1000), ("id",), partitions=3)
    got = batch_summary(numbered, 300).orderBy("batch").collect()
    assert [tuple(r) for r in got] == [
        (1, 300, 1, 300), (2, 300, 301, 600), (3, 300, 601, 900), (4, 100, 901, 1000),
    ]
    assert with_batch(numbered, 300).filter("row_number = 300").first().batch == 1
