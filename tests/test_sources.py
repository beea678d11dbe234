"""Readers, copies, unions, tables and views."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tripmill.fixed_values import MONTHS
from tripmill.session import new_folder
from tripmill.sources.copies import MANIFEST, DamagedCopy, parquet_if_absent, read_manifest
from tripmill.sources.files import (
    TRIP_SCHEMA,
    month_paths,
    path_coverage,
    read_csv,
    split_rejected,
    union_by_position,
)
from tripmill.sources.tables import query_view, read_table

HEADER = ",".join(TRIP_SCHEMA.names)


def write_month(folder, month, start_id):
    row = f"r{month},bike,2022-{month}-01 00:00:00,2022-{month}-01 00:10:00,Clark St,{start_id},Elm St,E1,41.5,-87.5,41.6,-87.6,member"
    (folder / f"divvy_tripdata_2022{month}.csv").write_text(f"{HEADER}\n{row}\n")


def test_month_paths_for_any_store():
    for base in ("s3a://bucket", "wasbs://box@account.blob.core.windows.net/", "/data"):
        paths = month_paths(base, 2022)
        assert len(paths) == 12
        assert paths[0] == f"{base.rstrip('/')}/divvy_tripdata_202201.csv"
    assert month_paths("/d", 2021, ("07",), "t-{year}-{month}.csv") == ["/d/t-2021-07.csv"]


def test_ids_stay_text_though_one_month_looks_numeric(spark, tmp_path):
    for month in MONTHS:
        write_month(tmp_path, month, "13285" if month == "01" else "chargingstx3")
    trips = read_csv(spark, month_paths(str(tmp_path), 2022))
    assert trips.count() == 12
    assert dict(trips.dtypes)["start_station_id"] == "string"
    assert dict(trips.dtypes)["started_at"] == "timestamp_ntz"
    found = trips.filter("start_station_id = '13285'").collect()
    assert [r.ride_id for r in found] == ["r01"]


def test_a_file_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("ended_at,started_at\n2022-01-01 00:00:00,2022-01-01 00:00:00\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_csv(spark, str(path)).collect()


def test_union_keeps_order_of_columns_duplicates_and_text(spark):
    a = spark.createDataFrame([("x", 1)], "id string, n int")
    b = spark.createDataFrame([(5, 1), (5, 1)], "other int, m int")
    both = union_by_position([a, b])
    assert both.columns == ["id", "n"] and dict(both.dtypes)["id"] == "string"
    assert sorted(r.id for r in both.collect()) == ["5", "5", "x"]
    with pytest.raises(ValueError, match="columns"):
        union_by_position([a, a.select("id")])


def test_parquet_copy_is_built_once(spark):
    path, built = new_folder(spark, "copy"), []

    def build():
        built.append(1)
        return spark.range(len(built) * 10)

    assert parquet_if_absent(spark, path, build).count() == 10
    assert parquet_if_absent(spark, path, build).count() == 10
    assert built == [1]


def test_half_a_copy_raises_or_is_rebuilt(spark, tmp_path):
    path = tmp_path / "copy"
    ten = lambda: spark.range(10, numPartitions=4)
    assert parquet_if_absent(spark, str(path), ten).count() == 10
    folder = path / read_manifest(spark, str(path))["folder"]
    (folder / "_SUCCESS").unlink()
    assert parquet_if_absent(spark, str(path), ten).count() == 10  # the manifest is what counts
    next(folder.glob("part-*.parquet")).unlink()
    with pytest.raises(DamagedCopy, match="missing"):
        parquet_if_absent(spark, str(path), ten)
    assert parquet_if_absent(spark, str(path), lambda: spark.range(7), rebuild=True).count() == 7
    assert parquet_if_absent(spark, str(path), ten).count() == 7
    added = path / read_manifest(spark, str(path))["folder"] / "part-99.parquet"
    added.write_bytes(next(folder.glob("part-*.parquet")).read_bytes())
    with pytest.raises(DamagedCopy, match="part-99"):
        parquet_if_absent(spark, str(path), ten)


def test_a_build_that_was_lost_is_as_good_as_none(spark, tmp_path):
    path = tmp_path / "copy"
    with pytest.raises(Exception, match="lost"):
        parquet_if_absent(spark, str(path), lambda: spark.range(10).select(F.raise_error(F.lit("lost")).alias("id")))
    spark.range(5).write.parquet(str(path / "copy-of-a-lost-driver"))
    (path / "_temporary").mkdir()
    assert parquet_if_absent(spark, str(path), lambda: spark.range(3)).count() == 3
    assert read_manifest(spark, str(path))["rows"] == 3


def test_builders_at_once_give_one_copy(spark, tmp_path):
    path, start = str(tmp_path / "copy"), threading.Barrier(4)

    def build(n):
        start.wait()
        return spark.range(n)

    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda n: parquet_if_absent(spark, path, lambda: build(n)).count(), (5, 6, 7, 8)))
    assert set(counts) == {read_manifest(spark, path)["rows"]}


def test_what_others_have_written(spark, tmp_path):
    path = tmp_path / "copy"
    spark.range(3).withColumn("day", F.lit("a b")).write.partitionBy("day").parquet(str(path))
    assert parquet_if_absent(spark, str(path), lambda: spark.range(10)).count() == 3
    assert (path / MANIFEST).exists()
    half = tmp_path / "half"
    spark.range(3).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    with pytest.raises(DamagedCopy, match="_SUCCESS"):
        parquet_if_absent(spark, str(half), lambda: spark.range(10))
    assert parquet_if_absent(spark, str(half), lambda: spark.range(10), rebuild=True).count() == 10


def test_values_that_do_not_parse_fail_or_are_told(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    Path(path).write_text("id,n\na,1\nb,1/1/2022\nc,3\n")
    schema = StructType([StructField("id", StringType()), StructField("n", IntegerType())])
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, path, schema).collect()
    good, bad = split_rejected(read_csv(spark, path, schema, rejected="rest").cache(), "rest")
    assert sorted(good.collect()) == [("a", 1), ("c", 3)]
    assert [r.rest for r in bad.collect()] == ["b,1/1/2022"]


def test_table_and_view(spark):
    spark.range(3).withColumn("_rescued_data", F.lit("x")).write.saveAsTable("trips_with_rest")
    assert read_table(spark, "trips_with_rest").columns == ["id"]
    view = query_view(spark.range(5), "numbers", "SELECT id FROM numbers WHERE id > 2")
    assert view.count() == 2


def test_folders_are_new_and_shared(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(base)


class Session:
    """As much of a session as the choice of a folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId="app")


def test_only_a_local_session_may_use_a_temporary_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_folder(Session("spark://host:7077"), "x")
    assert new_folder(Session("spark://host:7077", "hdfs://h/c/"), "x").startswith("hdfs://h/c/tripmill/x-")
    assert "/run-" in new_folder(Session("local[4]"), "x")


def test_coverage_names_what_is_missing_or_empty(spark, tmp_path):
    base = tmp_path / "a dir"
    base.mkdir()
    for month in MONTHS[:3]:
        write_month(base, month, "S1")
    (base / "divvy_tripdata_202203.csv").write_text(HEADER + "\n")
    bad = base / "divvy_tripdata_202202.csv"
    bad.write_text(bad.read_text() + "r9,bike,yesterday,2022-02-01 00:10:00,A,B,C,D,1,2,3,4,member\n")
    found = {r.path[-6:-4]: r for r in path_coverage(spark, month_paths(str(base), 2022)).collect()}
    assert len(found) == 12
    assert [(found[m].state, found[m].n_rows, found[m].n_rejected, found[m].n_files) for m in MONTHS[:4]] == [
        ("read", 1, 0, 1), ("read", 2, 1, 1), ("empty", 0, 0, 0), ("missing", 0, 0, 0)
    ]
    assert found["01"].n_values == 13 and found["02"].n_values >= 13
    none = path_coverage(spark, month_paths(str(tmp_path / "none"), 2022)).collect()
    assert {r.state for r in none} == {"missing"} and len(none) == 12


def test_a_union_of_nothing_raises(spark):
    with pytest.raises(ValueError, match="no frame"):
        union_by_position([])
