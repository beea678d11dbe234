"""The exploration of a trip table: every audit, check and count, by name.

Audits end their order with the unique column of the rules, see ``find_rows``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tripmill.fixed_values import OPERATOR_WORD, TEMP_WORD, TEST_WORD
from tripmill.functions.text import (
    any_contains,
    any_of,
    column,
    has_outer_blanks,
    is_all_lower,
    is_all_upper,
    text_columns,
)
from tripmill.operators.audit import (
    counts_where,
    find_rows,
    null_counts,
    rows_with_outer_blanks,
)
from tripmill.operators.clean import (
    TripRules,
    clean_trips,
    is_complete,
    is_public_ride,
    long_rides,
    tidy_names,
    trim_and_complete,
    trim_text,
    with_ride_length,
)
from tripmill.sources.copies import parquet_if_absent

DEFAULT = TripRules()


def short_rides(
    trips: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    """Complete rides below the minimum length, shortest first."""
    rides = with_ride_length(trim_and_complete(trips), rules)
    too_short = column(rules.ride_length) < rules.min_seconds
    return find_rows(rides, too_short, (rules.ride_length, rules.tie_break), limit=limit)


def upper_start(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    order = (rules.start_name, rules.tie_break)
    return find_rows(rides, is_all_upper(column(rules.start_name)), order, limit=limit)


def upper_end(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    """Ordered by the start name."""
    order = (rules.start_name, rules.tie_break)
    return find_rows(rides, is_all_upper(column(rules.end_name)), order, limit=limit)


def lower_start(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    order = (rules.start_name, rules.tie_break)
    return find_rows(rides, is_all_lower(column(rules.start_name)), order, limit=limit)


def lower_end(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    order = (rules.end_name, rules.tie_break)
    return find_rows(rides, is_all_lower(column(rules.end_name)), order, limit=limit)


def start_ids_with(
    rides: DataFrame, word: str = OPERATOR_WORD, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    """Start ids that hold a word, in this letter case."""
    return find_rows(
        rides,
        any_contains([rules.start_id], word, ignore_case=False),
        (rules.start_name, rules.tie_break),
        (rules.start_id, rules.start_name),
        limit,
    )


def ends_with_word(
    rides: DataFrame, word: str = OPERATOR_WORD, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    """End ids or names that hold a word, in this letter case."""
    return find_rows(
        rides,
        any_contains([rules.end_id, rules.end_name], word, ignore_case=False),
        (rules.end_name, rules.tie_break),
        (rules.end_id, rules.end_name),
        limit,
    )


def stations_with(
    rides: DataFrame,
    word: str,
    order_by: tuple = (),
    limit: int | None = None,
    rules: TripRules = DEFAULT,
) -> DataFrame:
    """Rides with a word, in any letter case, in one of their four station columns."""
    columns = (rules.start_id, rules.start_name, rules.end_id, rules.end_name)
    return find_rows(rides, any_contains(columns, word), order_by, columns, limit)


def test_stations(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    order = (F.desc(rules.end_name), rules.tie_break)
    return stations_with(rides, TEST_WORD, order, limit, rules)


def temporary_stations(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    order = (rules.start_name, rules.tie_break)
    return stations_with(rides, TEMP_WORD, order, limit, rules)


def starred_stations(
    rides: DataFrame, limit: int | None = None, rules: TripRules = DEFAULT
) -> DataFrame:
    """In no order."""
    return stations_with(rides, "*", (), limit, rules)


def start_lookup(trips: DataFrame, station_id: str, rules: TripRules = DEFAULT) -> DataFrame:
    columns = (rules.start_id, rules.start_name)
    return find_rows(trips, column(rules.start_id) == station_id, (), columns)


def end_lookup(trips: DataFrame, station_id: str, rules: TripRules = DEFAULT) -> DataFrame:
    columns = (rules.end_id, rules.end_name)
    return find_rows(trips, column(rules.end_id) == station_id, (), columns)


def _steps(rides: DataFrame, rules: TripRules) -> dict[str, Column]:
    """By step, which trimmed trips with a length are left after it; ``short`` are those it drops."""
    complete = is_complete(rides)
    long = complete & (column(rules.ride_length) >= rules.min_seconds)
    return {
        "trips": F.lit(True),
        "complete": complete,
        "short": complete & (column(rules.ride_length) < rules.min_seconds),
        "long": long,
        "cleaned": long & is_public_ride(rules),
    }


def step_counts(trips: DataFrame, rules: TripRules = DEFAULT) -> DataFrame:
    """One row: how many trips are left after each cleaning step, in one pass."""
    rides = with_ride_length(trim_text(trips), rules)
    return counts_where(rides, _steps(rides, rules))


def counted_clean_trips(trips: DataFrame, rules: TripRules = DEFAULT) -> tuple[DataFrame, Observation]:
    """The cleaned trips, and an observation that has the step counts once they are written.

    The counts are taken from the rows of the job that writes them, at no other pass: ask
    ``observation.get`` after the action. The action has to read the frame to its end and
    once, so no limit, and no ``number_rows`` on top, which samples its input first.
    """
    rides = with_ride_length(trim_text(trips), rules)
    steps, observation = _steps(rides, rules), Observation()
    # Three-valued tests drop a row if they are null, and count_if passes over it alike.
    seen = rides.observe(observation, *[F.count_if(left).alias(name) for name, left in steps.items()])
    return tidy_names(seen.filter(steps["cleaned"]), rules), observation


def audits_at_once(trips: DataFrame, rows: int = 6, rules: TripRules = DEFAULT) -> DataFrame:
    """The first ``rows`` rows of every audit, by one scan of the trips.

    ``audit``, ``place`` (from 1, in the audit's order) and the ride's columns with its
    length, trimmed but in the audit of outer blanks. A row is tagged with a bit for each audit that
    it belongs to, and a tagged row stands once for each of them. Each task keeps an audit's first rows
    only, so what is shuffled is bounded by the number of tasks, whatever an audit finds.
    Equal rows of an order follow the unique column of the rules, and so do audits without an order.
    """
    raw, blanks = "__raw_", "__blanks"
    text = set(text_columns(trips))
    outer = any_of(has_outer_blanks(column(c)) for c in text_columns(trips))
    kept = [column(c).alias(f"{raw}{c}") for c in trips.columns if c in text]
    both = trips.select(*[F.trim(column(c)).alias(c) if c in text else column(c) for c in trips.columns], *kept, outer.alias(blanks))
    rides = with_ride_length(both, rules)
    names = [*trips.columns, rules.ride_length]
    complete = is_complete(rides.select(*[column(c) for c in trips.columns]))
    length = column(rules.ride_length)
    long = complete & (length >= rules.min_seconds)
    start, end = column(rules.start_name), column(rules.end_name)
    stations = (rules.start_id, rules.start_name, rules.end_id, rules.end_name)
    none = F.lit(None)
    # name: rows, ascending order, descending order
    audits = {
        "rows with outer blanks": (column(blanks), none, none),
        "short rides": (complete & (length < rules.min_seconds), length, none),
        "all-upper-case start names": (long & is_all_upper(start), start, none),
        "start ids of the operator": (long & any_contains([rules.start_id], OPERATOR_WORD, ignore_case=False), start, none),
        "all-upper-case end names": (long & is_all_upper(end), start, none),
        "end stations of the operator": (long & any_contains([rules.end_id, rules.end_name], OPERATOR_WORD, ignore_case=False), end, none),
        "all-lower-case start names": (long & is_all_lower(start), start, none),
        "all-lower-case end names": (long & is_all_lower(end), end, none),
        "test stations": (long & any_contains(stations, TEST_WORD), none, end),
        "temporary stations": (long & any_contains(stations, TEMP_WORD), start, none),
        "starred stations": (long & any_contains(stations, "*"), none, none),
    }
    bits = sum((F.when(found, F.lit(1 << k)).otherwise(F.lit(0)) for k, (found, _, _) in enumerate(audits.values())), F.lit(0))
    tagged = rides.withColumn("__bits", bits).filter("__bits <> 0")
    belongs = [F.when(F.col("__bits").bitwiseAND(F.lit(1 << k)) != 0, F.lit(k)) for k in range(len(audits))]
    each = tagged.withColumn("__audit", F.explode(F.array_compact(F.array(*belongs))))

    def by_audit(values: list[Column], kind: str) -> Column:
        chosen = F.lit(None).cast(kind)
        for k, value in enumerate(values):
            chosen = F.when(F.col("__audit") == k, value.cast(kind)).otherwise(chosen)
        return chosen

    by_length = F.when(F.col("__audit") == list(audits).index("short rides"), length)
    rising = by_audit([none if name == "short rides" else up for name, (_, up, _) in audits.items()], "string")
    falling = by_audit([down for _, _, down in audits.values()], "string")
    order = Window.partitionBy("__audit").orderBy(by_length, rising, F.desc(falling), column(rules.tie_break))
    first = each.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows)
    as_found = F.col("__audit") == list(audits).index("rows with outer blanks")
    values = [F.when(as_found, column(f"{raw}{c}")).otherwise(column(c)).alias(c) if c in text else column(c) for c in names]
    return first.select(by_audit([F.lit(name) for name in audits], "string").alias("audit"), "place", *values)


def explore(
    trips: DataFrame, rows: int = 6, copy: str | None = None, rules: TripRules = DEFAULT
) -> dict[str, DataFrame]:
    """Every step of the exploration, each cut to its first rows for display.

    With ``copy``, the rides are written there as Parquet, if they are not yet,
    and the audits read the few columns they need from it instead of cleaning
    the trips again one by one.
    """
    def cleaned_rides() -> DataFrame:
        return long_rides(trips, rules)

    if copy is None:
        rides = cleaned_rides()
    else:
        rides = parquet_if_absent(trips.sparkSession, copy, cleaned_rides)
    trimmed = trim_text(trips)
    return {
        "rows with outer blanks": rows_with_outer_blanks(trips).limit(rows),
        "rows with outer blanks after the trim": rows_with_outer_blanks(trimmed).limit(rows),
        "nulls per column": null_counts(trimmed),
        "short rides": short_rides(trips, rows, rules),
        "all-upper-case start names": upper_start(rides, rows, rules),
        "start ids of the operator": start_ids_with(rides, OPERATOR_WORD, rows, rules),
        "all-upper-case end names": upper_end(rides, rows, rules),
        "end stations of the operator": ends_with_word(rides, OPERATOR_WORD, rows, rules),
        "all-lower-case start names": lower_start(rides, rows, rules),
        "all-lower-case end names": lower_end(rides, rows, rules),
        "test stations": test_stations(rides, rows, rules),
        "temporary stations": temporary_stations(rides, rows, rules),
        "starred stations": starred_stations(rides, rows, rules),
        "trips left after each step": step_counts(trips, rules),
        "cleaned trips": clean_trips(trips, rules).limit(rows),
    }
