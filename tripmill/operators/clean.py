"""Cleaning steps. Each one is a projection or a filter; none shuffles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tripmill.fixed_values import (
    ASTERISK_PATTERN,
    MIN_RIDE_SECONDS,
    REPAIR_STATION,
    TEMP_PATTERN,
    TEST_WORD,
)
from tripmill.functions.text import (
    any_contains,
    any_of,
    column,
    equals_ignoring_case,
    is_all_upper,
    quoted,
    remove_pattern,
    text_columns,
)
from tripmill.functions.time import seconds_between


@dataclass(frozen=True)
class TripRules:
    """Which columns the steps look at, and what they look for."""

    start: str = "started_at"
    end: str = "ended_at"
    start_name: str = "start_station_name"
    end_name: str = "end_station_name"
    start_id: str = "start_station_id"
    end_id: str = "end_station_id"
    # unique; settles the order of trips that are equal otherwise
    tie_break: str = "ride_id"
    ride_length: str = "ride_length"
    min_seconds: int = MIN_RIDE_SECONDS
    blocked_words: tuple[str, ...] = (TEST_WORD,)
    blocked_values: tuple[str, ...] = (REPAIR_STATION,)
    # applied in this order
    removals: tuple[str, ...] = (ASTERISK_PATTERN, TEMP_PATTERN)

    @property
    def names(self) -> tuple[str, str]:
        return (self.start_name, self.end_name)

    @property
    def stations(self) -> tuple[str, ...]:
        return (*self.names, self.start_id, self.end_id)


def trim_text(df: DataFrame) -> DataFrame:
    """Trim blanks (tabs stay) off every text column; order and names are kept."""
    text = set(text_columns(df))
    return df.selectExpr(
        *[f"trim({quoted(c)}) AS {quoted(c)}" if c in text else quoted(c) for c in df.columns]
    )


def is_complete(df: DataFrame, keep_nan: bool = False) -> Column:
    """No column is null or, unless they are kept, NaN."""
    terms = [f"{quoted(f.name)} IS NOT NULL" for f in df.schema.fields]
    if not keep_nan:
        terms += [
            f"NOT isnan({quoted(f.name)})"
            for f in df.schema.fields
            if isinstance(f.dataType, (FloatType, DoubleType))
        ]
    return F.expr(" AND ".join(terms))


def drop_incomplete(df: DataFrame, keep_nan: bool = False) -> DataFrame:
    """Drop rows with a null, or NaN, in any column.

    Same rows as ``dropna``, but one null test per column, which the Parquet
    scan can evaluate; ``dropna`` is a single opaque count to it. ``keep_nan``
    gives the rows that ``IS NOT NULL`` on every column keeps.
    """
    return df.filter(is_complete(df, keep_nan))


def trim_and_complete(df: DataFrame) -> DataFrame:
    """Complete rows with trimmed text.

    A trim neither makes nor removes a null, so testing the raw columns first
    gives the same rows and lets the tests reach the scan. Text of blanks only
    is not null: it is kept here, as ''.
    """
    return trim_text(drop_incomplete(df))


def with_ride_length(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    return df.withColumn(
        rules.ride_length, seconds_between(column(rules.start), column(rules.end))
    )


def keep_long_rides(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    return df.filter(column(rules.ride_length) >= rules.min_seconds)


def is_public_ride(rules: TripRules = TripRules()) -> Column:
    """Not between test, maintenance or all-upper-case stations.

    A null station makes the rule null, and the row is dropped.
    """
    blocked = [
        *[is_all_upper(column(n)) for n in rules.names],
        *[any_contains(rules.stations, w) for w in rules.blocked_words],
        *[
            any_of(equals_ignoring_case(column(s), v) for s in rules.stations)
            for v in rules.blocked_values
        ],
    ]
    return ~any_of(blocked)


def tidy_names(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Remove the marks from station names, one pattern after the other."""
    for pattern in rules.removals:
        df = df.withColumns({n: remove_pattern(column(n), pattern) for n in rules.names})
    return df


def long_rides(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """Trimmed, complete rides of at least the minimum length."""
    return keep_long_rides(with_ride_length(trim_and_complete(df), rules), rules)


def clean_trips(df: DataFrame, rules: TripRules = TripRules()) -> DataFrame:
    """The whole cleaning sequence: one filter and one projection over the scan."""
    return tidy_names(long_rides(df, rules).filter(is_public_ride(rules)), rules)
