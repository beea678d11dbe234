"""Cleaning rules on hand-made rows."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripmill.functions.text import equals_ignoring_case
from tripmill.plans.queries import clean_trips_from_copy
from tripmill.functions.text import column, has_outer_blanks
from tripmill.operators.audit import null_counts, rows_with_outer_blanks, schema_table
from tripmill.operators.clean import (
    TripRules,
    clean_trips,
    drop_incomplete,
    is_public_ride,
    long_rides,
    tidy_names,
    trim_and_complete,
    trim_text,
    with_ride_length,
)
from tripmill.plans.derived_trips import derived_trips
from tripmill.plans.exploration import explore

SCHEMA = """ride_id bigint, started_at timestamp_ntz, ended_at timestamp_ntz,
    start_station_name string, start_station_id string,
    end_station_name string, end_station_id string, start_lat double"""
START = datetime(2022, 5, 1, 12, 0, 0)


def trip(number, start="Clark St", start_id="S1", end="Elm St", end_id="E1", lat=41.5, seconds=600.0):
    return (number, START, START + timedelta(seconds=seconds), start, start_id, end, end_id, lat)


@pytest.fixture(scope="module")
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def ids(df):
    return sorted(r.ride_id for r in df.select("ride_id").collect())


def test_trim_takes_blanks_only_and_keeps_order_and_types(frame):
    df = frame(trip(1, start="  a b  ", end="\tc\t"))
    trimmed = trim_text(df)
    assert trimmed.dtypes == df.dtypes
    row = trimmed.first()
    assert (row.start_station_name, row.end_station_name) == ("a b", "\tc\t")


def test_outer_blank_flags(frame):
    df = frame(trip(1, start=" a"), trip(2), trip(3, end_id=None), trip(4, end="\tx"))
    found = rows_with_outer_blanks(df)
    assert ids(found) == [1]
    assert found.columns[: len(df.columns)] == df.columns
    assert found.first().start_station_name_has_whitespace is True
    assert rows_with_outer_blanks(trim_text(df)).count() == 0


def test_blank_flag_is_false_on_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(has_outer_blanks(F.col("t"))).first()[0] is False


def test_null_and_nan_rows_are_dropped_as_dropna_does(frame):
    df = frame(trip(1), trip(2, start=None), trip(3, lat=float("nan")), trip(4, lat=None))
    assert ids(drop_incomplete(df)) == ids(df.dropna()) == [1]


def test_blank_only_text_is_not_null(frame):
    """A blank name falls to the upper-case rule, a blank id is kept."""
    df = frame(trip(1, start="   "), trip(2, start_id="   "))
    assert ids(trim_and_complete(df)) == [1, 2]
    cleaned = clean_trips(df)
    assert ids(cleaned) == [2]
    assert cleaned.first().start_station_id == ""


def test_null_tests_reach_the_scan(spark, tmp_path, frame, capsys):
    path = str(tmp_path / "trips")
    frame(trip(1)).write.parquet(path)
    clean_trips(spark.read.parquet(path)).explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for name in ("start_station_name", "end_station_id", "start_lat", "ended_at"):
        assert f"IsNotNull({name})" in pushed
    assert "Exchange" not in plan


def test_ride_length_subtracts_whole_second_readings(spark):
    df = spark.sql(
        """SELECT timestamp_ntz'2022-01-01 00:00:05.5' AS started_at,
                  timestamp_ntz'2022-01-01 00:01:05.1' AS ended_at"""
    )
    assert with_ride_length(df).first().ride_length == 60


def test_short_and_negative_rides_are_dropped(frame):
    df = frame(*[trip(n, seconds=s) for n, s in enumerate([-5.0, 0.0, 59.0, 60.0, 61.0])])
    assert ids(long_rides(df)) == [3, 4]


@pytest.mark.parametrize(
    ("values", "kept"),
    [
        ({}, True),
        ({"start": "WEST CHI-WATSON"}, False),
        ({"end": "WEST CHI-WATSON"}, False),
        ({"start": "13285"}, False),
        ({"start_id": "WEST", "end_id": "13285"}, True),
        ({"start": "Base - Hubbard Test"}, False),
        ({"end": "latest news"}, False),
        ({"start_id": "DIVVY 001 - Warehouse test station"}, False),
        ({"end_id": "TEST-9"}, False),
        ({"start_id": "DIVVY 001"}, True),
        ({"end_id": "DIVVY CASSETTE REPAIR MOBILE STATION"}, False),
        ({"end": "Divvy Cassette Repair Mobile Station"}, False),
        ({"end": "Divvy Cassette Repair Mobile Station 2"}, True),
        ({"start": None}, False),
        ({"start_id": None}, False),
    ],
)
def test_station_rule(frame, values, kept):
    assert (frame(trip(1, **values)).filter(is_public_ride()).count() == 1) is kept


def test_rule_follows_its_parameters(frame):
    rules = TripRules(blocked_words=("depot",), blocked_values=(), min_seconds=10)
    df = frame(trip(1, start="Test St"), trip(2, end="Old Depot"), trip(3, seconds=10.0))
    assert ids(clean_trips(df, rules)) == [1, 3]


@pytest.mark.parametrize(
    ("name", "tidy"),
    [
        ("Green St & Randolph St*", "Green St & Randolph St"),
        ("Wood St & Taylor St (Temp)", "Wood St & Taylor St"),
        ("Lake St (Temp)*", "Lake St"),
        ("Pine * & Oak *(Temp)", "Pine & Oak"),
        ("Elm St (temp)", "Elm St (temp)"),
        ("two  *blanks", "two blanks"),
        ("a  *(Temp)", "a"),
        ("(Te*mp)x", "x"),
        ("tab\t*", "tab"),
        ("plain", "plain"),
        ("**", ""),
    ],
)
def test_marks_are_removed_one_pattern_after_the_other(frame, name, tidy):
    assert tidy_names(frame(trip(1, start=name))).first().start_station_name == tidy


def test_the_four_checks_after_cleaning(frame):
    df = frame(
        trip(1, start="Green St & Randolph St*", start_id="chargingstx3"),
        trip(2, end="Wood St & Taylor St (Temp)", end_id="13285"),
        trip(3, end_id="DIVVY CASSETTE REPAIR MOBILE STATION"),
        trip(4, start_id="DIVVY 001 - Warehouse test station"),
    )
    rows = {r.ride_id: r for r in clean_trips(df).collect()}
    assert sorted(rows) == [1, 2]
    assert rows[1].start_station_name == "Green St & Randolph St"
    assert rows[2].end_station_name == "Wood St & Taylor St"


def test_cleaning_twice_changes_nothing(spark):
    once = clean_trips(derived_trips(spark, "/root/testdata/sf0.001"))
    twice = clean_trips(once.drop("ride_length"))
    assert once.exceptAll(twice).count() == 0 == twice.exceptAll(once).count()


def test_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(" a ", None)], "`b.c` string, `d e` string")
    assert trim_text(df).first()[0] == "a"
    assert null_counts(df).first().asDict() == {"b.c": 0, "d e": 1}
    assert df.select(column("b.c")).first()[0] == " a "


def test_a_zoned_timestamp_is_accepted(frame):
    zoned = frame(trip(1)).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("started_at", "ended_at")}
    )
    assert clean_trips(zoned).first().ride_length == 600


def test_schema_table(frame):
    rows = schema_table(frame(trip(1))).collect()
    assert [r.column_name for r in rows][:2] == ["ride_id", "started_at"]
    assert rows[1].data_type == "timestamp_ntz"


def test_exploration_covers_every_step(spark):
    report = explore(derived_trips(spark, "/root/testdata/sf0.001"))
    assert len(report) == 15
    counts = {name: df.count() for name, df in report.items()}
    assert counts["rows with outer blanks after the trim"] == 0
    assert max(counts.values()) <= 6
    left = report["trips left after each step"].first().asDict()
    assert left == {"trips": 1000, "complete": 941, "short": 152, "long": 789, "cleaned": 528}


def test_zoneless_trips_do_not_depend_on_the_session_zone(spark):
    def rows():
        return clean_trips(derived_trips(spark, "/root/testdata/sf0.001")).toPandas()

    before, utc = spark.conf.get("spark.sql.session.timeZone"), rows()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert rows().equals(utc)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lower_case_is_compared_whatever_the_length(spark):
    df = spark.createDataFrame([("\u0130STANBUL",), ("istanbul",)], "t string")
    found = df.filter(equals_ignoring_case(F.col("t"), "i\u0307stanbul")).collect()
    assert [r.t for r in found] == ["\u0130STANBUL"]


def test_null_tests_reach_the_scan_of_a_copy(spark):
    plan = clean_trips_from_copy(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(start_station_name)" in plan.split("PushedFilters")[1] and "Generate" not in plan
