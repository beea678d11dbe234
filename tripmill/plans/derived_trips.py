"""Trips derived from the ``events`` table, with every defect the rules look for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TRIP = {
    "ride_id": "event_id",
    # cut to the hour without a detour through the session's time zone
    "started_at": """CASE WHEN event_id % 4 = 0
        THEN ts - make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts)) ELSE ts END""",
    "ended_at": "timestampadd(SECOND, CAST(floor(value * 10) - 60 AS INT), ts)",
    "start_station_name": """CASE WHEN event_id % 97 = 0 THEN NULL
        WHEN event_id % 20 < 10 THEN get(array(
          '  Clark St & Elm St ', 'Green St & Randolph St*', 'Wood St & Taylor St (Temp)',
          'WEST CHI-WATSON', 'Base - Hubbard Test', 'Lake St (Temp)*', 'Elm St (temp)',
          '13285', '   ', 'plain lower st'), CAST(event_id % 20 AS INT))
        ELSE 'Station ' || event_type END""",
    "start_station_id": """CASE WHEN event_id % 89 = 0 THEN NULL
        WHEN event_id % 31 = 0 THEN 'DIVVY 001 - Warehouse test station'
        WHEN event_id % 37 = 0 THEN 'DIVVY 001'
        WHEN event_id % 41 = 0 THEN 'chargingstx3'
        ELSE 'S' || user_id END""",
    "end_station_name": """CASE WHEN event_id % 83 = 0 THEN NULL
        WHEN event_id % 29 = 0 THEN 'DIVVY CASSETTE REPAIR MOBILE STATION'
        WHEN event_id % 23 = 0 THEN 'Divvy Cassette Repair Mobile Station'
        WHEN event_id % 7 = 0 THEN 'Pine * & Oak *(Temp)'
        WHEN event_id % 19 = 0 THEN 'dock lower'
        ELSE 'Dock ' || event_type || ' ' END""",
    "end_station_id": """CASE WHEN event_id % 79 = 0 THEN NULL
        WHEN event_id % 29 = 0 THEN 'DIVVY CASSETTE REPAIR MOBILE STATION'
        WHEN event_id % 43 = 0 THEN 'TEST-9'
        WHEN event_id % 13 = 0 THEN '13285'
        ELSE 'E' || (user_id % 17) END""",
    "start_lat": "41.5D + value / 1000",
    "start_lng": "-87.0D - value / 1000",
    "end_lat": "CASE WHEN event_id % 73 = 0 THEN NULL ELSE 41.6D + value / 2000 END",
    "end_lng": "-87.1D - value / 2000",
    "member_type": "event_type",
}


def derived_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    trip = ", ".join(f"{expression} AS {name}" for name, expression in TRIP.items())
    # Selected directly, these expressions would be copied into every later
    # filter that names a column, and be evaluated once per mention.
    return events.selectExpr(f"inline(array(struct({trip})))")
