"""From raw trips to keyed trips in a store."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tripmill.fixed_values import BATCH_ROWS
from tripmill.operators.clean import TripRules, clean_trips
from tripmill.operators.numbering import number_rows, with_trip_keys
from tripmill.operators.store_form import values_as_text
from tripmill.sinks.keyed import write_keyed
from tripmill.sources.files import TRIP_SCHEMA, month_paths, read_csv
from tripmill.sources.tables import read_table


@dataclass(frozen=True)
class StorePlan:
    """How trips are numbered, keyed and written."""

    rules: TripRules = field(default_factory=TripRules)
    number: str = "row_number"
    key: str = "trip_id"
    sort_key: str = "started_at_timestamp"
    # columns that address an item in the store
    store_keys: tuple[str, ...] = ("trip_id", "started_at_timestamp")
    as_text: bool = False
    batch_rows: int = BATCH_ROWS
    # columns to leave out of the stored items, such as row_number
    leave_out: tuple[str, ...] = ()
    persist: StorageLevel | None = None


# A store addressed by a hash key and a range key, one that takes native types ...
PAIR_KEYED = StorePlan()
# ... one addressed by a single 'id' ...
ID_KEYED = StorePlan(key="id", store_keys=("id",))
# ... and one whose items hold text only.
TEXT_ITEMS = StorePlan(as_text=True)


def keyed_trips(
    trips: DataFrame, plan: StorePlan = PAIR_KEYED, numbered_path: str | None = None
) -> DataFrame:
    """Cleaned trips with row number and keys. Runs the numbering job."""
    numbered = number_rows(
        clean_trips(trips, plan.rules),
        (plan.rules.start, plan.rules.tie_break),
        plan.number,
        path=numbered_path,
        persist=plan.persist,
    )
    return with_trip_keys(
        numbered, plan.rules.start, plan.number, plan.key, plan.sort_key
    )


def store_items(keyed: DataFrame, plan: StorePlan = PAIR_KEYED) -> DataFrame:
    """The keyed trips as the store is to hold them."""
    if plan.as_text:
        keyed = values_as_text(keyed, (plan.rules.start, plan.rules.end))
    return keyed.drop(*plan.leave_out)


def load_store(
    trips: DataFrame,
    sink: str,
    plan: StorePlan = PAIR_KEYED,
    numbered_path: str | None = None,
    **sink_options: str | int | float,
) -> None:
    """Clean, number, key and write trips to a registered keyed sink."""
    items = store_items(keyed_trips(trips, plan, numbered_path), plan)
    number = None if plan.number in plan.leave_out else plan.number
    write_keyed(items, sink, plan.store_keys, plan.batch_rows, number, **sink_options)


def csv_to_store(
    spark: SparkSession,
    base: str,
    year: int,
    sink: str,
    plan: StorePlan = PAIR_KEYED,
    months: Sequence[str] | None = None,
    schema=TRIP_SCHEMA,
    **sink_options: str | int | float,
) -> None:
    """Monthly CSV files below ``base`` (any Hadoop URI) to a store."""
    paths = month_paths(base, year) if months is None else month_paths(base, year, months)
    load_store(read_csv(spark, paths, schema), sink, plan, **sink_options)


def table_to_store(
    spark: SparkSession,
    table: str,
    sink: str,
    plan: StorePlan = TEXT_ITEMS,
    **sink_options: str | int | float,
) -> None:
    """A catalog table of trips to a store."""
    load_store(read_table(spark, table), sink, plan, **sink_options)
