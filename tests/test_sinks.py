"""The keyed sink: batches, retries, repeated writes, read-back."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.operators.upsert import latest_by_key, upsert
from tripmill.plans.derived_trips import derived_trips
from tripmill.plans.preparation import ID_KEYED, TEXT_ITEMS, StorePlan, load_store, table_to_store
from tripmill.session import new_folder
from recording_store import (
    SINK_NAME,
    FileStore,
    next_write,
    read_store,
    register_file_store,
    write_report,
)
from tripmill import storage
from tripmill.sinks import keyed_table
from tripmill.sinks.keyed_table import compact, read_items, remove_old, write_items, write_sizes
from tripmill.sinks.keyed import batches_to_put, cut_batches, dealt_by_batch, register_keyed_sink, with_retry, write_keyed

SMALL = "/root/testdata/sf0.001"


def numbers(values):
    return pa.RecordBatch.from_pydict({"n": pa.array(values, pa.int64())})


def stream(count, pieces, first=1):
    """first..first+count-1 in record batches of the given lengths, over and over."""
    at, last, turn = first, first + count, 0
    while at < last:
        size = pieces[turn % len(pieces)]
        yield numbers(range(at, min(at + size, last)))
        at, turn = at + size, turn + 1


def cut(*args, **kwargs):
    return [b.column("n").to_pylist() for b in cut_batches(*args, **kwargs)]


@settings(max_examples=60, deadline=None)
@given(
    count=st.integers(0, 200),
    pieces=st.lists(st.integers(1, 40), min_size=1, max_size=5),
    size=st.integers(1, 50),
    first=st.integers(1, 120),
)
def test_batches_keep_every_row_in_order(count, pieces, size, first):
    rows = list(range(first, first + count))
    plain = cut(stream(count, pieces, first), size)
    assert plain == [rows[i : i + size] for i in range(0, count, size)]

    aligned = cut(stream(count, pieces, first), size, "n")
    assert [r for batch in aligned for r in batch] == rows
    for batch in aligned:
        assert len({(r - 1) // size for r in batch}) == 1
    assert len(aligned) == len({(r - 1) // size for r in rows})


def test_empty_record_batches_are_skipped():
    assert cut(iter([numbers([]), numbers([1]), numbers([])]), 2) == [[1]]


def test_retry_waits_longer_each_time_and_gives_up():
    waits, calls = [], []

    def fail():
        calls.append(1)
        raise OSError("busy")

    with pytest.raises(OSError):
        with_retry(fail, (OSError,), 5, 2, 2, waits.append)
    assert len(calls) == 5 and waits == [2, 4, 8, 16]


def test_retry_succeeds_later_and_other_errors_pass_through():
    left = [OSError(), OSError()]

    def action():
        if left:
            raise left.pop()

    assert with_retry(action, (OSError,), 5, 0, 2) == 2

    def broken():
        raise KeyError("x")

    waits = []
    with pytest.raises(KeyError):
        with_retry(broken, (OSError,), 5, 1, 2, waits.append)
    assert waits == []


@pytest.fixture
def store(spark):
    register_file_store(spark)
    return new_folder(spark, "store")


def put(df, path, keys, **options):
    number = next_write()
    write_keyed(df, SINK_NAME, keys, path=path, writeNumber=number, **options)
    return write_report(path, number)


def test_written_rows_are_read_back_and_counted(spark, store):
    df = spark.range(1, 1001, numPartitions=2).withColumn("v", F.col("id").cast("string"))
    report = put(df, store, ["id"])
    assert report == {"partitions": 2, "rows": 1000, "batches": 4, "retries": 0}
    assert read_store(spark, store, ["id"]).exceptAll(df).count() == 0
    assert read_store(spark, store, ["id"]).count() == 1000


def test_batches_follow_the_row_numbers(spark, store):
    """500 + 500 rows: the partition edge cuts no batch."""
    df = spark.range(1, 1001, numPartitions=2).withColumnRenamed("id", "row_number")
    report = put(df, store, ["row_number"], number="row_number")
    assert report["rows"] == 1000 and report["batches"] == 4


def test_a_later_write_replaces_and_a_repeated_one_changes_nothing(spark, store):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    put(old, store, ["k"])
    put(new, store, ["k"])
    want = {1: "a", 2: "c", 3: "d"}
    assert {r.k: r.v for r in read_store(spark, store, ["k"]).collect()} == want
    put(new, store, ["k"])
    assert {r.k: r.v for r in read_store(spark, store, ["k"]).collect()} == want


def test_two_key_columns(spark, store):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, s string, v int")
    put(df, store, ["k", "s"])
    assert read_store(spark, store, ["k", "s"]).count() == 2


def test_a_transient_failure_is_retried_on_the_executor(spark, store):
    class Flaky(FileStore):
        def open(self, partition):
            super().open(partition)
            self.failures = 2

        def put(self, items):
            if self.failures:
                self.failures -= 1
                raise OSError("throttled")
            super().put(items)

    register_keyed_sink(spark, "flaky", Flaky)
    number = next_write()
    write_keyed(
        spark.range(700, numPartitions=1), "flaky", ["id"],
        path=store, writeNumber=number, delaySeconds=0.01,
    )
    assert write_report(store, number) == {"partitions": 1, "rows": 700, "batches": 3, "retries": 2}
    assert read_store(spark, store, ["id"]).count() == 700


def test_a_lasting_failure_fails_the_write(spark, store):
    class Down(FileStore):
        def put(self, items):
            raise OSError("down for good")

    register_keyed_sink(spark, "down", Down)
    with pytest.raises(Exception, match="down for good"):
        write_keyed(
            spark.range(10), "down", ["id"], path=store, writeNumber=1, delaySeconds=0, tries=2
        )


def test_overwrite_and_missing_keys_are_refused(spark, store):
    writer = spark.range(1).write.format(SINK_NAME).option("path", store)
    with pytest.raises(Exception, match="append"):
        writer.option("keys", "id").mode("overwrite").save()
    with pytest.raises(Exception, match="keys"):
        spark.range(1).write.format(SINK_NAME).option("path", store).mode("append").save()


def test_rate_limit_slows_the_write(spark, store):
    import time

    began = time.time()
    put(spark.range(1, 31, numPartitions=1), store, ["id"], batch_rows=10, batchesPerSecond=5)
    assert time.time() - began >= 0.6


def run_job(folder, body):
    """Run a job of its own, in a directory from which workers cannot import the package."""
    script = folder / "job.py"
    script.write_text(
        f"""
import sys
sys.path[:0] = [{str(Path(__file__).resolve().parents[1])!r}, {str(Path(__file__).resolve().parent)!r}]
from tripmill.session import build_session
import recording_store
from recording_store import *
from tripmill.sinks.keyed import register_keyed_sink, write_keyed
from pyspark import TaskContext, cloudpickle
cloudpickle.register_pickle_by_value(recording_store)
spark = build_session("job", "local[2,3]", {{"spark.ui.enabled": "false"}})
path = {str(folder / "store")!r}
{body}
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)],
        cwd=folder, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout


def test_executors_need_no_copy_of_the_package(tmp_path):
    body = """
register_file_store(spark)
write_keyed(spark.range(10), SINK_NAME, ["id"], path=path, writeNumber=1)
print("ROWS", read_store(spark, path, ["id"]).count())
"""
    assert "ROWS 10" in run_job(tmp_path, body)


def test_a_task_lost_halfway_is_run_again(tmp_path):
    """Every first attempt dies after some of its batches are put."""
    body = """
class Lost(FileStore):
    def put(self, items):
        super().put(items)
        self._flush()
        if TaskContext.get().attemptNumber() == 0 and items.column("id")[0].as_py() % 1000 > 400:
            raise RuntimeError("executor lost")

register_keyed_sink(spark, "lost", Lost)
df = spark.range(2000, numPartitions=2)
write_keyed(df, "lost", ["id"], path=path, writeNumber=1)
stored = spark.read.parquet(path)
print("FILES", len(stored.inputFiles()), "ROWS", stored.count(), "SUM", stored.agg({"id": "sum"}).first()[0])
print("REPORT", write_report(path, 1)["rows"])
"""
    out = run_job(tmp_path, body)
    assert f"FILES 2 ROWS 2000 SUM {sum(range(2000))}" in out
    assert "REPORT 2000" in out


@pytest.mark.parametrize("n, partitions, tasks", [(1000, 7, 3), (1000, 1, 8), (900, 16, None), (1, 1, 5), (0, 2, 2), (301, 300, 1)])
def test_numbered_rows_are_put_in_exact_batches(spark, store, n, partitions, tasks):
    df = spark.range(1, n + 1).withColumnRenamed("id", "row number").repartition(partitions)
    number = next_write()
    write_keyed(df, SINK_NAME, ["row number"], 300, "row number", tasks, path=store, writeNumber=number)
    report = write_report(store, number)
    assert report["rows"] == n and report["batches"] == -(-n // 300)
    puts = batches_to_put(dealt_by_batch(df, "row number", 300, tasks), "row number", 300).collect()
    assert sorted(r.first_row for r in puts) == list(range(1, n + 1, 300))
    assert all(r.n_rows == r.last_row - r.first_row + 1 <= 300 for r in puts)


def test_latest_by_key_and_its_plan(spark, capsys):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    latest = latest_by_key(events, ("user_id", "event_type"), ("event_id",))
    assert latest.columns == events.columns
    want = events.groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"))
    got = latest.select("user_id", "event_type", "event_id")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 750
    latest.explain()
    plan = capsys.readouterr().out
    assert "partial_max_by" in plan and "Window" not in plan


def test_latest_by_key_with_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert latest_by_key(df, ("k",), ("k",)).count() == 2


def test_latest_by_key_with_null_keys_and_null_values(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, None), (1, 1, "b")], "k int, o int, v string")
    rows = {r.k: r.v for r in latest_by_key(df, ("k",), ("o",)).collect()}
    assert rows == {None: None, 1: "b"}


def test_upsert_replaces_adds_and_keeps(spark):
    target = spark.createDataFrame([(1, 9, "a"), (2, 9, "b")], "k int, o int, v string")
    batch = spark.createDataFrame([(2, 1, "x"), (2, 2, "y"), (3, 1, "z")], "k int, o int, v string")
    after = upsert(target, batch, ("k",), ("o",))
    assert {r.k: r.v for r in after.collect()} == {1: "a", 2: "y", 3: "z"}
    again = upsert(after, batch, ("k",), ("o",))
    assert {r.k: r.v for r in again.collect()} == {1: "a", 2: "y", 3: "z"}


def test_whole_job_keyed_by_id(spark, store):
    number = next_write()
    plan = StorePlan(**{**ID_KEYED.__dict__, "leave_out": ("row_number", "ride_length")})
    load_store(derived_trips(spark, SMALL), SINK_NAME, plan, path=store, writeNumber=number)
    stored = read_store(spark, store, ["id"])
    assert stored.count() == 528 == write_report(store, number)["rows"]
    assert "row_number" not in stored.columns
    assert stored.agg(F.max("id")).first()[0] == "TRIP_0000528"


def test_whole_job_from_a_table_with_text_items(spark, store):
    derived_trips(spark, SMALL).withColumn("_rescued_data", F.lit(None).cast("string")).write.saveAsTable(
        "trip_table"
    )
    table_to_store(spark, "trip_table", SINK_NAME, TEXT_ITEMS, path=store, writeNumber=next_write())
    stored = read_store(spark, store, list(TEXT_ITEMS.store_keys))
    assert stored.count() == 528
    types = dict(stored.dtypes)
    assert types["started_at"] == types["start_lat"] == "string"


def test_report_is_json(spark, store):
    put(spark.range(5), store, ["id"])
    files = list(Path(store).rglob("_report.json"))
    assert len(files) == 1 and json.loads(files[0].read_text())["rows"] == 5


def test_items_of_a_failed_flush_are_stored_once(spark, store):
    class Shaky(FileStore):
        failed = False

        def _flush(self):
            if not self.failed:
                self.failed = True
                raise OSError("try again")
            super()._flush()

    register_keyed_sink(spark, "shaky", Shaky)
    write_keyed(spark.range(70_000, numPartitions=1), "shaky", ["id"], path=store, writeNumber=1, delaySeconds=0)
    assert spark.read.parquet(store).count() == write_report(store, 1)["rows"] == 70_000
    assert write_report(store, 1)["retries"] == 1


def test_keys_are_checked(spark, store):
    with pytest.raises(Exception, match="no such key"):
        put(spark.range(3), store, ["other"])
    with pytest.raises(Exception, match="null"):
        put(spark.range(3).select(F.when(F.col("id") > 0, F.col("id")).alias("id")), store, ["id"])


def test_a_keyed_table_merges_writes_and_columns(spark):
    folder = new_folder(spark, "items")
    write_items(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), folder, ["k"], write=1)
    write_items(spark.createDataFrame([(2, "c", 5)], "k int, v string, w int"), folder, ["k"], write=2)
    assert sorted(map(tuple, read_items(spark, folder, ["k"]).select("k", "v", "w").collect())) == [(1, "a", None), (2, "c", 5)]
    assert {r.put_order: r.n_rows for r in write_sizes(spark, folder).collect()} == {1: 2, 2: 1}
    with pytest.raises(Exception, match="a key is null"):
        write_items(spark.createDataFrame([(None, "a")], "k int, v string"), folder, ["k"])


def test_a_write_takes_the_next_number_and_none_twice(spark):
    folder = new_folder(spark, "items")
    first = spark.createDataFrame([(1, 5)], "k int, put_order int")
    assert [write_items(first, folder, ["k"]) for _ in range(3)] == [0, 1, 2]
    with pytest.raises(ValueError, match="already"):
        write_items(first, folder, ["k"], write=1)
    assert read_items(spark, folder, ["k"]).collect() == [(1, 5)]
    with pytest.raises(ValueError, match="no keyed table"):
        read_items(spark, new_folder(spark, "none"), ["k"])
    write_items(spark.createDataFrame([(1, "x")], "k int, put_order string"), folder, ["k"])
    with pytest.raises(ValueError, match="put_order was written as int and string"):
        read_items(spark, folder, ["k"])


def test_a_lost_write_does_not_count(spark):
    folder = new_folder(spark, "items")
    write_items(spark.createDataFrame([(1, "a")], "k int, v string"), folder, ["k"])
    with pytest.raises(Exception, match="a key is null"):
        write_items(spark.createDataFrame([(k, "b") for k in range(9)] + [(None, "b")], "k int, v string").repartition(3), folder, ["k"])
    spark.createDataFrame([(1, "c")], "k int, v string").write.parquet(f"{folder}/__write=w-lost")
    assert read_items(spark, folder, ["k"]).collect() == [(1, "a")]


def written_at_random(spark, folder, n_writes, state):
    for n in range(n_writes):
        rows = [(k, f"user {k % 3}", f"{n} {k}") for k in range(n, 60, n + 1)]
        state.update({r[:2]: r[2] for r in rows})
        write_items(spark.createDataFrame(rows, "k int, `u.ser` string, v string"), folder, ["k", "u.ser"])


def state_of(items):
    return {(r[0], r[1]): r[2] for r in items.collect()}


def test_compaction_and_newer_writes(spark, monkeypatch):
    folder, keys, state = new_folder(spark, "items"), ["k", "u.ser"], {}
    written_at_random(spark, folder, 5, state)
    assert state_of(read_items(spark, folder, keys)) == state
    compact(spark, folder, keys, bucket_bytes=3000)
    files = read_items(spark, folder, keys).inputFiles()
    assert len(files) > 1 and all("/base-" in f for f in files)
    assert state_of(read_items(spark, folder, keys)) == state
    written_at_random(spark, folder, 2, state)
    read = read_items(spark, folder, keys)
    assert state_of(read) == state and read.count() == len(state)
    assert {"base" if "/base-" in f else "write" for f in read.inputFiles()} == {"base", "write"}
    assert len({f for f in read.inputFiles() if "__write" in f}) <= 2 * 8

    def lost(*_):
        raise RuntimeError("driver lost")

    before = sorted(read.inputFiles())
    with monkeypatch.context() as patch:
        patch.setattr(keyed_table, "_publish", lost)
        with pytest.raises(RuntimeError):
            compact(spark, folder, keys)
    assert sorted(read_items(spark, folder, keys).inputFiles()) == before
    compact(spark, folder, keys)
    compact(spark, folder, keys)
    remove_old(spark, folder)
    assert len([e for e in storage.entries(spark, folder) if e.is_folder]) == 2  # one base and the log
    assert state_of(read_items(spark, folder, keys)) == state
    assert [r.n_rows for r in write_sizes(spark, folder).collect()] == [len(range(n, 60, n + 1)) for n in (0, 1, 2, 3, 4, 0, 1)]


def test_wanted_keys_open_their_buckets_only(spark, capsys):
    folder = new_folder(spark, "items")
    items = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("u"), F.col("id") % 7).alias("u"), F.rand(1).alias("v"))
    write_items(items, folder, ["k", "u"])
    compact(spark, folder, ["k", "u"], bucket_bytes=20_000)
    write_items(spark.createDataFrame([(5, "u5", 2.0)], "k long, u string, v double"), folder, ["k", "u"])
    wanted = [(5, "u5"), (6, "u6"), (7, "u1")]
    found = read_items(spark, folder, ["k", "u"], wanted)
    assert sorted((r.k, r.v == 2.0) for r in found.collect()) == [(5, True), (6, False)]
    found.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "__bucket" in plan.split("PartitionFilters: [")[1][:300]
    n_buckets = len([e for e in storage.entries(spark, folder + "/" + next(e.name for e in storage.entries(spark, folder) if e.name.startswith("base-"))) if e.is_folder])
    assert n_buckets > 5


def test_null_keys_are_equal_in_an_upsert(spark):
    old = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int")
    new = spark.createDataFrame([(None, 2)], "k int, v int")
    assert sorted(r.v for r in upsert(old, new, ["k"], ["v"]).collect()) == [1, 2]
