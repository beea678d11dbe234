"""Order and completeness of the audits, and the rules against plain Python."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmill.functions.text import any_of, has_outer_blanks, text_columns
from tripmill.operators.audit import counts_where, find_rows
from tripmill.operators.clean import clean_trips, long_rides
from tripmill.operators.numbering import kept_in_between
from tripmill.plans import exploration as ex
from tripmill.plans.derived_trips import derived_trips
from tripmill.session import new_folder

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rides(spark):
    return long_rides(derived_trips(spark, MIDDLE)).cache()


@pytest.mark.parametrize(
    ("find", "order", "descending"),
    [
        (ex.upper_start, ("start_station_name",), False),
        (ex.upper_end, ("start_station_name",), False),
        (ex.lower_start, ("start_station_name",), False),
        (ex.lower_end, ("end_station_name",), False),
        (ex.start_ids_with, ("start_station_name",), False),
        (ex.ends_with_word, ("end_station_name",), False),
        (ex.test_stations, ("end_station_name",), True),
        (ex.temporary_stations, ("start_station_name",), False),
    ],
)
def test_audits_are_ordered_and_limits_take_the_first(rides, find, order, descending):
    rows = find(rides).collect()
    keys = [tuple(r[c] for c in order) for r in rows]
    assert keys == sorted(keys, reverse=descending)
    assert find(rides, limit=6).collect() == rows[:6]


def test_short_rides_come_shortest_first(spark):
    rows = ex.short_rides(derived_trips(spark, MIDDLE)).collect()
    lengths = [r.ride_length for r in rows]
    assert lengths == sorted(lengths) and lengths[0] < 0 and lengths[-1] < 60
    assert ex.short_rides(derived_trips(spark, MIDDLE), limit=6).collect() == rows[:6]


def test_a_limited_audit_is_a_top_k_without_a_full_sort(rides, capsys):
    ex.upper_start(rides, 6).explain()
    plan = capsys.readouterr().out
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_a_full_sort_can_split_a_name_with_a_third_of_the_rows(spark):
    rows = spark.range(90_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name")
    )
    ordered = find_rows(rows, F.lit(True), ("name", "id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 2 * 90_000 / 8


def test_exploration_from_a_copy(spark):
    trips, folder = derived_trips(spark, MIDDLE), new_folder(spark, "rides")
    direct, copied = ex.explore(trips), ex.explore(trips, copy=folder)
    for name in ("all-upper-case end names", "test stations", "temporary stations"):
        assert direct[name].collect() == copied[name].collect()


def test_counts_where_ignores_unknown(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    row = counts_where(df, {"big": F.col("a") > 2, "all": F.lit(True)}).first()
    assert (row.big, row["all"]) == (1, 3)


PIECES = [
    "Test", "test", "TEST", " ", "  ", "*", " *", "(Temp)", "(temp)", " (Temp)", "\t", "A", "b",
    "St", "13", "DIVVY", "Divvy Cassette Repair Mobile Station", "é", "É", "ß", "(Te", "mp)",
]


def by_hand(row):
    """The cleaning rules on one row: None where it is dropped."""
    row = dict(row)
    if any(v is None for v in row.values()):
        return None
    stations = ("start_station_name", "end_station_name", "start_station_id", "end_station_id")
    for c in stations:
        row[c] = row[c].strip(" ")
    row["ride_length"] = int(row["ended_at"].timestamp() // 1 - row["started_at"].timestamp() // 1)
    if row["ride_length"] < 60:
        return None
    if any(row[c].upper() == row[c] for c in stations[:2]):
        return None
    for c in stations:
        low = row[c].lower()
        if "test" in low or low == "divvy cassette repair mobile station":
            return None
    for c in stations[:2]:
        row[c] = re.sub(r"\s?\(Temp\)", "", re.sub(r"\s?\*", "", row[c]))
    return row


def test_cleaning_equals_the_rules_by_hand(spark):
    draw = random.Random(11)

    def text():
        if draw.random() < 0.05:
            return None
        if draw.random() < 0.1:
            return "Divvy Cassette REPAIR Mobile Station"
        return "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 5)))

    rows = []
    for number in range(4000):
        start = datetime(2022, 1, 1) + timedelta(microseconds=draw.randrange(10**12))
        rows.append(
            {
                "ride_id": number,
                "started_at": start,
                "ended_at": start + timedelta(microseconds=draw.randrange(-10**7, 3 * 10**8)),
                "start_station_name": text(),
                "end_station_name": text(),
                "start_station_id": text(),
                "end_station_id": text(),
            }
        )
    schema = """ride_id bigint, started_at timestamp_ntz, ended_at timestamp_ntz,
        start_station_name string, end_station_name string,
        start_station_id string, end_station_id string"""
    got = clean_trips(spark.createDataFrame(rows, schema)).collect()
    want = [r for r in map(by_hand, rows) if r is not None]
    assert len(want) > 100
    assert sorted((r.asDict() for r in got), key=lambda r: r["ride_id"]) == want


def test_all_audits_at_once_equal_the_single_ones(spark, capsys):
    trips = derived_trips(spark, "/root/testdata/sf0.001")
    rides = long_rides(trips)
    at_once = ex.audits_at_once(trips, 4).cache()
    single = {
        "rows with outer blanks": find_rows(trips, rows_with_outer_blanks_term(trips), ("ride_id",), limit=4),
        "short rides": ex.short_rides(trips, 4),
        "all-upper-case start names": ex.upper_start(rides, 4),
        "start ids of the operator": ex.start_ids_with(rides, limit=4),
        "all-upper-case end names": ex.upper_end(rides, 4),
        "end stations of the operator": ex.ends_with_word(rides, limit=4),
        "all-lower-case start names": ex.lower_start(rides, 4),
        "all-lower-case end names": ex.lower_end(rides, 4),
        "test stations": ex.test_stations(rides, 4),
        "temporary stations": ex.temporary_stations(rides, 4),
    }
    for name, want in single.items():
        got = at_once.filter(F.col("audit") == name).orderBy("place").select(*want.columns).collect()
        assert got == want.collect() and got, name
    assert {r.audit for r in at_once.select("audit").collect()} == {*single, "starred stations"}
    at_once.unpersist()
    ex.audits_at_once(trips, 4).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 1 and "WindowGroupLimit" in plan


def rows_with_outer_blanks_term(trips):
    return any_of(has_outer_blanks(F.col(c)) for c in text_columns(trips))


def test_audits_of_an_empty_table(spark):
    assert ex.audits_at_once(derived_trips(spark, "/root/testdata/sf0.001").limit(0)).count() == 0


def test_counts_of_a_written_job_need_no_other_job(spark, tmp_path):
    trips = derived_trips(spark, "/root/testdata/sf0.001")
    cleaned, counts = ex.counted_clean_trips(trips)
    spark.sparkContext.setJobGroup("counted", "")
    cleaned.write.parquet(str(tmp_path / "cleaned"))
    found = counts.get
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == ex.step_counts(trips).first().asDict()
    assert len(jobs) == 1
    stored = spark.read.parquet(str(tmp_path / "cleaned"))
    want = clean_trips(trips)
    assert stored.columns == want.columns and stored.exceptAll(want).count() == 0 and stored.count() == found["cleaned"]


def test_a_kept_frame_is_given_up_though_the_work_fails(spark):
    frame = spark.range(5).withColumn("x", F.rand())
    with pytest.raises(RuntimeError), kept_in_between(frame) as kept:
        assert kept.is_cached and kept.count() == 5
        raise RuntimeError
    assert not frame.is_cached
