"""The registered queries. Each one reads whole tables of ``sf_dir``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.fixed_values import REPAIR_STATION, RESCUED_COLUMN, TEST_WORD
from tripmill.functions.text import any_contains, contains_word
from tripmill.operators import audit
from tripmill.operators.clean import clean_trips, drop_incomplete, long_rides, trim_and_complete, trim_text
from tripmill.operators.numbering import kept_in_between, number_rows, row_range
from tripmill.operators.store_form import batch_summary
from tripmill.operators.upsert import latest_by_key, upsert
from tripmill.plans import exploration as ex
from tripmill.plans.derived_trips import derived_trips
from tripmill.plans.preparation import ID_KEYED, TEXT_ITEMS, keyed_trips, store_items
from tripmill.session import new_folder
from tripmill.sinks.keyed import batches_to_put, dealt_by_batch
from tripmill.sinks.keyed_table import compact, read_items, write_items, write_sizes
from tripmill.sources.copies import parquet_if_absent
from tripmill.sources.files import month_paths, path_coverage, read_csv, union_by_position
from tripmill.sources.inference import file_types, read_inferred, read_text, type_name
from tripmill.sources.tables import query_view, read_table

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on_trips(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(derived_trips(spark, sf_dir))


def _on_rides(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(long_rides(derived_trips(spark, sf_dir)))


def _on_clean(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(clean_trips(derived_trips(spark, sf_dir)))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def _blank_rows_left(trips: DataFrame) -> DataFrame:
    return _count(audit.rows_with_outer_blanks(trim_text(trips)))


def _short_rides(trips: DataFrame) -> DataFrame:
    return ex.short_rides(trips).select("started_at", "ended_at", "ride_length")


def _shortest_rides(trips: DataFrame) -> DataFrame:
    return ex.short_rides(trips, limit=6).select("ride_id", "started_at", "ended_at", "ride_length")


def _test_stations_first(rides: DataFrame) -> DataFrame:
    columns = ("start_station_id", "start_station_name", "end_station_id", "end_station_name")
    return audit.find_rows(
        rides,
        any_contains(columns, TEST_WORD),
        (F.desc("end_station_name"), "ride_id"),
        ("ride_id", *columns),
        10,
    )


def word_test_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.find_rows(
        _table(spark, sf_dir, "documents"),
        contains_word(F.col("text"), TEST_WORD),
        (F.desc("source"), "doc_id"),
        ("doc_id", "source", "lang", "n_chars"),
        10,
    )


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count(_table(spark, sf_dir, "orders"))


def numbered_row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return row_range(number_rows(events, ("ts", "event_id")), 301, 600)


def keyed_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_trips(derived_trips(spark, sf_dir), ID_KEYED)


def batches_300(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_trips(derived_trips(spark, sf_dir)).select("started_at", "ride_id")
    return batch_summary(number_rows(cleaned, ("started_at", "ride_id")))


def batches_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches that the writer of a store cuts from the numbered trips, as its tasks get them."""
    return batches_to_put(dealt_by_batch(keyed_trips(derived_trips(spark, sf_dir)), "row_number"), "row_number")


def store_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_items(keyed_trips(derived_trips(spark, sf_dir), TEXT_ITEMS), TEXT_ITEMS)


_NO_MONTH = "00"
_MICROSECONDS = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.coalesce(F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.lit(_NO_MONTH))
    return _table(spark, sf_dir, "orders").withColumn("month", month)


def _months_of(orders: DataFrame) -> list[str]:
    """The folders there are: at most twelve months, and that of rows without a date."""
    return sorted(row["month"] for row in orders.select("month").distinct().collect())


def union_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as frames of their own, of which the even ones hold the key as text."""
    folder, orders = new_folder(spark, "months"), _by_month(spark, sf_dir)
    orders.write.partitionBy("month").parquet(folder)
    schema = orders.drop("month").schema
    frames = [
        spark.read.schema(schema).parquet(f"{folder}/month={m}").withColumn(
            "o_orderkey", F.col("o_orderkey").cast("string" if int(m) % 2 == 0 and k else "bigint")
        )
        for k, m in enumerate(_months_of(orders))
    ]
    return union_by_position(frames)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, orders = new_folder(spark, "csv"), _by_month(spark, sf_dir)
    orders.write.options(**_MICROSECONDS).partitionBy("month").csv(folder, header=True)
    paths = [f"{folder}/month={m}" for m in _months_of(orders)]
    return read_csv(spark, paths, orders.drop("month").schema, **_MICROSECONDS)


def csv_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV, of which every fiftieth has a price that is no number: none is lost."""
    folder, orders = new_folder(spark, "csv"), _table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 50 == 0, F.lit("41,1")).otherwise(F.col("o_totalprice").cast("string"))
    orders.withColumn("o_totalprice", price).write.options(**_MICROSECONDS).csv(folder, header=True)
    read = read_csv(spark, folder, orders.schema, rejected="_rescued_data", **_MICROSECONDS)
    return read.select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("_rescued_data").isNotNull().alias("rejected")
    )


def _uneven_months(spark: SparkSession, sf_dir: str) -> list[str]:
    """Orders as monthly CSV files, in some of which a column looks otherwise than in the rest."""
    folder, orders = new_folder(spark, "csv"), _by_month(spark, sf_dir)

    def only_in(month: str, changed: str, name: str) -> Column:
        return F.when(F.col("month") == month, F.expr(changed)).otherwise(F.col(name).cast("string"))

    uneven = orders.withColumns(
        {
            "o_orderkey": only_in("03", "concat('K', o_orderkey)", "o_orderkey"),
            "o_custkey": only_in("09", "CAST(o_custkey + 5000000000 AS STRING)", "o_custkey"),
            "o_totalprice": only_in("05", "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)", "o_totalprice"),
            "o_orderdate": only_in("07", "date_format(o_orderdate, 'yyyy-MM-dd')", "o_orderdate"),
            "o_orderpriority": only_in("11", "CAST(NULL AS STRING)", "o_orderpriority"),
        }
    )
    uneven.write.partitionBy("month").csv(folder, header=True)
    return [f"{folder}/month={m}" for m in _months_of(orders)]


def csv_inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The type that each month's values alone would have, whatever number of files holds them."""
    files = file_types(read_text(spark, _uneven_months(spark, sf_dir)))
    month = F.regexp_extract("file", "month=([0-9]+)", 1)
    merged = files.groupBy(month.alias("month"), "column_name").agg(
        F.sum("n_values").alias("n_values"), type_name(F.bit_and("bits")).alias("data_type")
    )
    return merged


def csv_inferred_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same months under the one schema that all their values fit."""
    return read_inferred(spark, _uneven_months(spark, sf_dir))


def month_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve asked months: one was never written, one is empty, some rows can't be read."""
    folder, orders = new_folder(spark, "csv"), _by_month(spark, sf_dir)
    price = F.when(F.col("o_orderkey") % 50 == 0, F.lit("41,1")).otherwise(F.col("o_totalprice").cast("string"))
    written = orders.withColumn("o_totalprice", price).filter(~F.col("month").isin("04", "08"))
    written.write.options(**_MICROSECONDS).partitionBy("month").csv(folder, header=True)
    orders.drop("month").limit(0).write.csv(f"{folder}/month=08", header=True)
    asked = month_paths(folder, 2022, pattern="month={month}")
    found = path_coverage(spark, asked, orders.drop("month").schema, **_MICROSECONDS)
    month = F.regexp_extract("path", "month=([0-9]+)", 1).alias("month")
    return found.select(month, "state", "n_rows", "n_rejected", "n_values")


def written_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The step counts as the job that writes the cleaned trips has observed them, beside what it wrote."""
    cleaned, counts = ex.counted_clean_trips(derived_trips(spark, sf_dir))
    folder = new_folder(spark, "cleaned")
    cleaned.write.parquet(folder)
    stored = spark.read.parquet(folder).agg(F.count("*").alias("stored"))
    return stored.withColumns({name: F.lit(n).cast("bigint") for name, n in counts.get.items()})


def persisted_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two counts from rides that are kept in between, and given up whether or not the work succeeds."""
    with kept_in_between(long_rides(derived_trips(spark, sf_dir))) as rides:
        counts = {"rides": rides.count(), "members": rides.select("member_type").distinct().count()}
    return spark.createDataFrame([tuple(counts.values())], "rides bigint, members bigint")


def schema_of_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the trips that a schema print shows, and how many values each has."""
    trips = derived_trips(spark, sf_dir)
    counts = trips.agg(*[F.count(c).alias(c) for c in trips.columns]).unpivot([], trips.columns, "column_name", "n_values")
    return audit.schema_table(trips).join(counts, "column_name").select("position", "column_name", "data_type", "n_values")


def drop_nulls_keep_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which some values are turned into null and some into NaN: the latter stay."""
    value = F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(
        F.col("event_id") % 7 == 0, F.lit(float("nan"))
    ).otherwise(F.col("value"))
    marked = _table(spark, sf_dir, "events").withColumn("value", value)
    return drop_incomplete(marked, keep_nan=True).select("event_id", F.isnan("value").alias("is_nan"))


def lookup_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the four stations that the checks ask for, before and after cleaning."""
    trips = derived_trips(spark, sf_dir)
    checks = {
        "starred": F.col("start_station_id") == "chargingstx3",
        "temporary": F.col("end_station_id") == "13285",
        "repair": F.col("end_station_id") == REPAIR_STATION.upper(),
        "warehouse": F.col("start_station_id") == "DIVVY 001 - Warehouse test station",
    }
    stages = {"before": trips, "after": clean_trips(trips)}
    counted = [
        audit.counts_where(frame, checks).withColumn("stage", F.lit(stage)) for stage, frame in stages.items()
    ]
    return counted[0].unionByName(counted[1])


def shortest_kept_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = long_rides(derived_trips(spark, sf_dir))
    return kept.orderBy("ride_length", "ride_id").limit(6).select("ride_id", "ride_length")


def _stored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as a Parquet copy, whose scan the null tests reach."""
    return parquet_if_absent(spark, new_folder(spark, "trips"), lambda: derived_trips(spark, sf_dir))


def clean_trips_from_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(_stored_trips(spark, sf_dir))


def upper_start_from_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.upper_start(long_rides(_stored_trips(spark, sf_dir)))


def parquet_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second build is not used: the copy is there by then."""
    folder = new_folder(spark, "copy")
    orders = _table(spark, sf_dir, "orders")
    parquet_if_absent(spark, folder, lambda: orders)
    return parquet_if_absent(spark, folder, lambda: orders.withColumn("o_orderstatus", F.lit("?")))


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external catalog table over the given files, with a bookkeeping column."""
    path, name = f"{sf_dir}/orders.parquet", f"orders_{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema.add(RESCUED_COLUMN, "string")
    spark.catalog.createTable(name, path, source="parquet", schema=schema)
    found = read_table(spark, name)
    spark.sql(f"DROP TABLE {name}")  # its files are given ones and stay
    return found


def view_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_view(
        _table(spark, sf_dir, "orders"),
        "orders_view",
        """SELECT o_orderkey, o_orderstatus, o_totalprice
           FROM orders_view WHERE o_orderkey IS NOT NULL""",
    )


_EVENT_KEYS = ("user_id", "event_type")


def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_by_key(_table(spark, sf_dir, "events"), _EVENT_KEYS, ("event_id",))


def _two_writes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events of 10 and more are written over all others."""
    events, later = _table(spark, sf_dir, "events"), F.coalesce(F.col("value") >= 10, F.lit(False))
    return events.filter(~later), events.filter(later)


def upsert_two_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _two_writes(spark, sf_dir)
    stored = latest_by_key(first, _EVENT_KEYS, ("event_id",))
    return upsert(stored, second, _EVENT_KEYS, ("event_id",))


def keyed_sink_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "store")
    write_items(upsert_result(spark, sf_dir), folder, _EVENT_KEYS)
    return read_items(spark, folder, _EVENT_KEYS)


def keyed_upsert_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write over existing keys."""
    folder = new_folder(spark, "store")
    for number, items in enumerate(_two_writes(spark, sf_dir)):
        write_items(items, folder, _EVENT_KEYS, ("event_id",), number)
    return read_items(spark, folder, _EVENT_KEYS)


def keyed_compacted_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writes, a compaction of them, and a write over the compacted items."""
    folder, events = new_folder(spark, "store"), _table(spark, sf_dir, "events")
    size = F.coalesce(F.col("value"), F.lit(0.0))
    for part in (size < 5, (size >= 5) & (size < 20)):
        write_items(events.filter(part), folder, _EVENT_KEYS, ("event_id",))
    compact(spark, folder, _EVENT_KEYS)
    write_items(events.filter(size >= 20), folder, _EVENT_KEYS, ("event_id",))
    return read_items(spark, folder, _EVENT_KEYS)


def store_trips_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job: clean, number, key, write, read the store back."""
    folder, keys = new_folder(spark, "store"), TEXT_ITEMS.store_keys
    write_items(store_text(spark, sf_dir), folder, keys)
    return read_items(spark, folder, keys)


def keyed_sink_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a write has stored."""
    folder = new_folder(spark, "store")
    write_items(_table(spark, sf_dir, "events"), folder, ["event_id"])
    return write_sizes(spark, folder).select("n_rows")


QUERIES: dict[str, Query] = {
    "trips_source": derived_trips,
    "whitespace_rows": _on_trips(audit.rows_with_outer_blanks),
    "whitespace_rows_after_trim": _on_trips(_blank_rows_left),
    "null_counts": _on_trips(lambda trips: audit.null_counts(trim_text(trips))),
    "trim_dropna": _on_trips(trim_and_complete),
    "step_counts": _on_trips(ex.step_counts),
    "written_step_counts": written_step_counts,
    "audits_at_once": _on_trips(ex.audits_at_once),
    "persisted_rides": persisted_rides,
    "schema_of_trips": schema_of_trips,
    "short_rides": _on_trips(_short_rides),
    "shortest_rides_top6": _on_trips(_shortest_rides),
    "long_rides": _on_trips(long_rides),
    "upper_start": _on_rides(ex.upper_start),
    "upper_end": _on_rides(ex.upper_end),
    "lower_start": _on_rides(ex.lower_start),
    "lower_end": _on_rides(ex.lower_end),
    "substr_start_id": _on_rides(ex.start_ids_with),
    "substr_end": _on_rides(ex.ends_with_word),
    "word_test": _on_rides(ex.test_stations),
    "word_test_top10": _on_rides(_test_stations_first),
    "word_temp": _on_rides(ex.temporary_stations),
    "char_star": _on_rides(ex.starred_stations),
    "clean_trips": _on_trips(clean_trips),
    "lookup_1": _on_clean(lambda df: ex.start_lookup(df, "chargingstx3")),
    "lookup_2": _on_clean(lambda df: ex.end_lookup(df, "13285")),
    "lookup_3": _on_clean(lambda df: _count(ex.end_lookup(df, REPAIR_STATION.upper()))),
    "lookup_4": _on_clean(
        lambda df: _count(ex.start_lookup(df, "DIVVY 001 - Warehouse test station"))
    ),
    "keyed_trips": lambda spark, sf_dir: keyed_trips(derived_trips(spark, sf_dir)),
    "keyed_by_id": keyed_by_id,
    "batches_300": batches_300,
    "batches_put": batches_put,
    "store_text": store_text,
    "row_range": numbered_row_range,
    "row_count": row_count,
    "word_test_desc_top10": word_test_documents,
    "union_months": union_months,
    "csv_round_trip": csv_round_trip,
    "csv_rejected_rows": csv_rejected_rows,
    "csv_inferred_types": csv_inferred_types,
    "csv_inferred_read": csv_inferred_read,
    "month_coverage": month_coverage,
    "drop_nulls_keep_nan": drop_nulls_keep_nan,
    "lookup_checks": lookup_checks,
    "shortest_kept_rides_top6": shortest_kept_rides,
    "clean_trips_from_copy": clean_trips_from_copy,
    "upper_start_from_copy": upper_start_from_copy,
    "keyed_upsert_read_back": keyed_upsert_read_back,
    "parquet_if_absent": parquet_copy,
    "table_scan": table_scan,
    "view_scan": view_scan,
    "upsert_result": upsert_result,
    "upsert_two_writes": upsert_two_writes,
    "keyed_sink_read_back": keyed_sink_read_back,
    "store_trips_read_back": store_trips_read_back,
    "keyed_sink_progress": keyed_sink_progress,
    "keyed_compacted_read_back": keyed_compacted_read_back,
}
