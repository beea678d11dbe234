"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT
    event_id AS ride_id,
    CASE WHEN event_id % 4 = 0 THEN date_trunc('hour', ts) ELSE ts END AS started_at,
    ts + to_seconds(CAST(floor(value * 10) AS BIGINT) - 60) AS ended_at,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 20 = 0 THEN '  Clark St & Elm St '
         WHEN event_id % 20 = 1 THEN 'Green St & Randolph St*'
         WHEN event_id % 20 = 2 THEN 'Wood St & Taylor St (Temp)'
         WHEN event_id % 20 = 3 THEN 'WEST CHI-WATSON'
         WHEN event_id % 20 = 4 THEN 'Base - Hubbard Test'
         WHEN event_id % 20 = 5 THEN 'Lake St (Temp)*'
         WHEN event_id % 20 = 6 THEN 'Elm St (temp)'
         WHEN event_id % 20 = 7 THEN '13285'
         WHEN event_id % 20 = 8 THEN '   '
         WHEN event_id % 20 = 9 THEN 'plain lower st'
         ELSE 'Station ' || event_type END AS start_station_name,
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN event_id % 31 = 0 THEN 'DIVVY 001 - Warehouse test station'
         WHEN event_id % 37 = 0 THEN 'DIVVY 001'
         WHEN event_id % 41 = 0 THEN 'chargingstx3'
         ELSE 'S' || user_id END AS start_station_id,
    CASE WHEN event_id % 83 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN 'DIVVY CASSETTE REPAIR MOBILE STATION'
         WHEN event_id % 23 = 0 THEN 'Divvy Cassette Repair Mobile Station'
         WHEN event_id % 7 = 0 THEN 'Pine * & Oak *(Temp)'
         WHEN event_id % 19 = 0 THEN 'dock lower'
         ELSE 'Dock ' || event_type || ' ' END AS end_station_name,
    CASE WHEN event_id % 79 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN 'DIVVY CASSETTE REPAIR MOBILE STATION'
         WHEN event_id % 43 = 0 THEN 'TEST-9'
         WHEN event_id % 13 = 0 THEN '13285'
         ELSE 'E' || (user_id % 17) END AS end_station_id,
    CAST(41.5 AS DOUBLE) + value / 1000 AS start_lat,
    CAST(-87.0 AS DOUBLE) - value / 1000 AS start_lng,
    CASE WHEN event_id % 73 = 0 THEN NULL
         ELSE CAST(41.6 AS DOUBLE) + value / 2000 END AS end_lat,
    CAST(-87.1 AS DOUBLE) - value / 2000 AS end_lng,
    event_type AS member_type
  FROM events
)"""

TRIMMED = TRIPS + """,
trimmed AS (
  SELECT * REPLACE (
    trim(start_station_name) AS start_station_name,
    trim(start_station_id) AS start_station_id,
    trim(end_station_name) AS end_station_name,
    trim(end_station_id) AS end_station_id,
    trim(member_type) AS member_type)
  FROM trips
)"""

COMPLETE = TRIMMED + """,
complete AS (
  SELECT *,
    CAST(floor(epoch(ended_at)) AS BIGINT) - CAST(floor(epoch(started_at)) AS BIGINT)
      AS ride_length
  FROM trimmed
  WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL
    AND start_station_name IS NOT NULL AND start_station_id IS NOT NULL
    AND end_station_name IS NOT NULL AND end_station_id IS NOT NULL
    AND start_lat IS NOT NULL AND start_lng IS NOT NULL
    AND end_lat IS NOT NULL AND end_lng IS NOT NULL AND member_type IS NOT NULL
)"""

RIDES = COMPLETE + """,
rides AS (SELECT * FROM complete WHERE ride_length >= 60)"""

CLEAN = RIDES + """,
cleaned AS (
  SELECT * REPLACE (
    regexp_replace(regexp_replace(start_station_name, '\\s?\\*', '', 'g'),
                   '\\s?\\(Temp\\)', '', 'g') AS start_station_name,
    regexp_replace(regexp_replace(end_station_name, '\\s?\\*', '', 'g'),
                   '\\s?\\(Temp\\)', '', 'g') AS end_station_name)
  FROM rides
  WHERE upper(start_station_name) <> start_station_name
    AND upper(end_station_name) <> end_station_name
    AND NOT EXISTS (
      SELECT 1 FROM (VALUES (start_station_name), (end_station_name),
                            (start_station_id), (end_station_id)) AS v(s)
      WHERE lower(s) LIKE '%test%' OR lower(s) = 'divvy cassette repair mobile station')
)"""

KEYED = CLEAN + """,
numbered AS (
  SELECT *, row_number() OVER (ORDER BY started_at, ride_id) AS row_number FROM cleaned
),
keyed AS (
  SELECT *, 'TRIP_' || printf('%07d', row_number) AS trip_id,
    strftime(started_at, '%Y%m%d%H%M%S') AS started_at_timestamp
  FROM numbered
)"""

STORED = KEYED + """,
stored AS (
  SELECT * REPLACE (
    strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at,
    strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS ended_at,
    CAST(start_lat AS VARCHAR) AS start_lat, CAST(start_lng AS VARCHAR) AS start_lng,
    CAST(end_lat AS VARCHAR) AS end_lat, CAST(end_lng AS VARCHAR) AS end_lng)
  FROM keyed
)"""

FLAGS = ", ".join(
    f"coalesce(length({c}) <> length(trim({c})), false) AS {c}_has_whitespace"
    for c in (
        "start_station_name",
        "start_station_id",
        "end_station_name",
        "end_station_id",
        "member_type",
    )
)
ANY_FLAG = """(start_station_name_has_whitespace OR start_station_id_has_whitespace
  OR end_station_name_has_whitespace OR end_station_id_has_whitespace
  OR member_type_has_whitespace)"""

TRIP_COLUMNS = (
    "ride_id started_at ended_at start_station_name start_station_id end_station_name "
    "end_station_id start_lat start_lng end_lat end_lng member_type"
).split()
STATIONS = "start_station_id, start_station_name, end_station_id, end_station_name"


def _stations_like(pattern: str) -> str:
    return " OR ".join(f"lower({c}) LIKE '{pattern}'" for c in STATIONS.split(", "))


LATEST_EVENTS = """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY event_id DESC) AS place
  FROM events
) WHERE place = 1"""

LATEST_WRITE = """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type
    ORDER BY coalesce(value >= 10, false) DESC, event_id DESC) AS place
  FROM events
) WHERE place = 1"""

#: Orders by month, changed in some months as the uneven files are.
UNEVEN = """months AS (
  SELECT *, coalesce(lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), '00') AS month FROM orders
), uneven AS (
  SELECT month,
    CASE WHEN month = '03' THEN 'K' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS o_orderkey,
    CASE WHEN month = '09' THEN o_custkey + 5000000000 ELSE o_custkey END AS o_custkey, o_orderstatus,
    CASE WHEN month = '05' THEN floor(o_totalprice) ELSE o_totalprice END AS o_totalprice,
    CASE WHEN month = '07' THEN date_trunc('day', o_orderdate) ELSE o_orderdate END AS o_orderdate,
    CASE WHEN month = '11' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM months
)"""
_AS_TEXT = """CASE column_name
  WHEN 'o_totalprice' THEN CASE WHEN month = '05' THEN CAST(CAST(CAST(value AS DOUBLE) AS BIGINT) AS VARCHAR) ELSE value END
  WHEN 'o_orderdate' THEN CASE WHEN month = '07' THEN left(value, 10) ELSE value END
  ELSE value END"""

_AUDITS = {
    "short rides": ("short", "true", "ride_length"),
    "all-upper-case start names": ("rides", "upper(start_station_name) = start_station_name", "start_station_name"),
    "start ids of the operator": ("rides", "start_station_id LIKE '%DIVVY%'", "start_station_name"),
    "all-upper-case end names": ("rides", "upper(end_station_name) = end_station_name", "start_station_name"),
    "end stations of the operator": ("rides", "end_station_id LIKE '%DIVVY%' OR end_station_name LIKE '%DIVVY%'", "end_station_name"),
    "all-lower-case start names": ("rides", "lower(start_station_name) = start_station_name", "start_station_name"),
    "all-lower-case end names": ("rides", "lower(end_station_name) = end_station_name", "end_station_name"),
    "test stations": ("rides", _stations_like("%test%"), "end_station_name DESC"),
    "temporary stations": ("rides", _stations_like("%temp%"), "start_station_name"),
    "starred stations": ("rides", _stations_like("%*%"), "1"),
    "rows with outer blanks": ("blank", "true", "1"),
}
_AUDIT_ROWS = " UNION ALL ".join(
    f"""SELECT '{name}' AS audit, * FROM (SELECT CAST(row_number() OVER (ORDER BY {order}, ride_id) AS INTEGER) AS place, *
      FROM {source} WHERE {where}) WHERE place <= 6"""
    for name, (source, where, order) in _AUDITS.items()
)

ORACLE_SQL: dict[str, str] = {
    "written_step_counts": f"""WITH {CLEAN} SELECT
        (SELECT count(*) FROM cleaned) AS stored,
        (SELECT count(*) FROM trips) AS trips,
        (SELECT count(*) FROM complete) AS complete,
        (SELECT count(*) FROM complete WHERE ride_length < 60) AS short,
        (SELECT count(*) FROM rides) AS long,
        (SELECT count(*) FROM cleaned) AS cleaned""",
    "audits_at_once": f"""WITH {RIDES}, short AS (SELECT * FROM complete WHERE ride_length < 60),
        flagged AS (SELECT *, {FLAGS} FROM trips),
        blank AS (SELECT * EXCLUDE ({", ".join(c + "_has_whitespace" for c in (
            "start_station_name", "start_station_id", "end_station_name", "end_station_id", "member_type"))}),
          CAST(floor(epoch(ended_at)) AS BIGINT) - CAST(floor(epoch(started_at)) AS BIGINT) AS ride_length
          FROM flagged WHERE {ANY_FLAG})
        {_AUDIT_ROWS}""",
    "persisted_rides": f"WITH {RIDES} SELECT count(*) AS rides, count(DISTINCT member_type) AS members FROM rides",
    "schema_of_trips": f"""WITH {TRIPS}, described AS ({" UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS column_name, '{kind}' AS data_type, count({c}) AS n_values FROM trips"
        for k, (c, kind) in enumerate(zip(TRIP_COLUMNS, (
            "bigint timestamp_ntz timestamp_ntz string string string string double double double double string"
        ).split()), start=1))}) SELECT * FROM described""",
    "csv_inferred_types": f"""WITH {UNEVEN}, cells AS (
          SELECT month, column_name, {_AS_TEXT} AS v FROM (
            SELECT month, o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
              CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
              o_orderpriority FROM uneven
          ) UNPIVOT INCLUDE NULLS (value FOR column_name IN
            (o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority))
        )
        SELECT month, column_name, count(v) AS n_values, CASE WHEN count(v) = 0 THEN NULL
          WHEN bool_and(regexp_full_match(v, '0|-?[1-9][0-9]*') AND TRY_CAST(v AS INTEGER) IS NOT NULL) THEN 'int'
          WHEN bool_and(regexp_full_match(v, '0|-?[1-9][0-9]*') AND TRY_CAST(v AS BIGINT) IS NOT NULL) THEN 'bigint'
          WHEN bool_and(regexp_full_match(v, '-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][-+]?[0-9]+)?')) THEN 'double'
          WHEN bool_and(regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST(v AS DATE) IS NOT NULL) THEN 'date'
          WHEN bool_and(regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}.*') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'timestamp_ntz'
          ELSE 'string' END AS data_type
        FROM cells GROUP BY month, column_name""",
    "csv_inferred_read": f"WITH {UNEVEN} SELECT * EXCLUDE (month) FROM uneven",
    "month_coverage": """
        WITH asked AS (
          SELECT lpad(CAST(m AS VARCHAR), 2, '0') AS month FROM range(1, 13) t(m)
        ), found AS (
          SELECT lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month, count(*) AS n_rows,
            count(*) FILTER (o_orderkey % 50 = 0) AS n_rejected,
            count(o_orderkey) + count(o_custkey) + count(o_orderstatus) + count(o_orderdate) + count(o_orderpriority)
              + count(o_totalprice) FILTER (o_orderkey % 50 <> 0) AS n_values
          FROM orders WHERE month(o_orderdate) NOT IN (4, 8) GROUP BY 1
        )
        SELECT month, CASE WHEN month = '04' THEN 'missing' WHEN n_rows IS NULL THEN 'empty' ELSE 'read' END AS state,
          coalesce(n_rows, 0) AS n_rows, coalesce(n_rejected, 0) AS n_rejected, coalesce(n_values, 0) AS n_values
        FROM asked LEFT JOIN found USING (month)""",
    "trips_source": f"WITH {TRIPS} SELECT * FROM trips",
    "whitespace_rows": f"""WITH {TRIPS}, flagged AS (SELECT *, {FLAGS} FROM trips)
        SELECT * FROM flagged WHERE {ANY_FLAG}""",
    "whitespace_rows_after_trim": f"""
        WITH {TRIMMED}, flagged AS (SELECT *, {FLAGS} FROM trimmed)
        SELECT count(*) AS n FROM flagged WHERE {ANY_FLAG}""",
    "null_counts": f"""WITH {TRIMMED} SELECT {", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in TRIP_COLUMNS)} FROM trimmed""",
    "trim_dropna": f"WITH {COMPLETE} SELECT * EXCLUDE (ride_length) FROM complete",
    "step_counts": f"""WITH {CLEAN} SELECT
        (SELECT count(*) FROM trips) AS trips,
        (SELECT count(*) FROM complete) AS complete,
        (SELECT count(*) FROM complete WHERE ride_length < 60) AS short,
        (SELECT count(*) FROM rides) AS long,
        (SELECT count(*) FROM cleaned) AS cleaned""",
    "short_rides": f"""WITH {COMPLETE}
        SELECT started_at, ended_at, ride_length FROM complete WHERE ride_length < 60""",
    "shortest_rides_top6": f"""WITH {COMPLETE}
        SELECT ride_id, started_at, ended_at, ride_length FROM complete
        WHERE ride_length < 60 ORDER BY ride_length, ride_id LIMIT 6""",
    "long_rides": f"WITH {RIDES} SELECT * FROM rides",
    "upper_start": f"""WITH {RIDES}
        SELECT * FROM rides WHERE upper(start_station_name) = start_station_name""",
    "upper_end": f"""WITH {RIDES}
        SELECT * FROM rides WHERE upper(end_station_name) = end_station_name""",
    "lower_start": f"""WITH {RIDES}
        SELECT * FROM rides WHERE lower(start_station_name) = start_station_name""",
    "lower_end": f"""WITH {RIDES}
        SELECT * FROM rides WHERE lower(end_station_name) = end_station_name""",
    "substr_start_id": f"""WITH {RIDES}
        SELECT start_station_id, start_station_name FROM rides
        WHERE start_station_id LIKE '%DIVVY%'""",
    "substr_end": f"""WITH {RIDES}
        SELECT end_station_id, end_station_name FROM rides
        WHERE end_station_id LIKE '%DIVVY%' OR end_station_name LIKE '%DIVVY%'""",
    "word_test": f"""WITH {RIDES}
        SELECT {STATIONS} FROM rides WHERE {_stations_like('%test%')}""",
    "word_test_top10": f"""WITH {RIDES}
        SELECT ride_id, {STATIONS} FROM rides WHERE {_stations_like('%test%')}
        ORDER BY end_station_name DESC, ride_id LIMIT 10""",
    "word_temp": f"""WITH {RIDES}
        SELECT {STATIONS} FROM rides WHERE {_stations_like('%temp%')}""",
    "char_star": f"""WITH {RIDES}
        SELECT {STATIONS} FROM rides WHERE {_stations_like('%*%')}""",
    "clean_trips": f"WITH {CLEAN} SELECT * FROM cleaned",
    "lookup_1": f"""WITH {CLEAN} SELECT start_station_id, start_station_name
        FROM cleaned WHERE start_station_id = 'chargingstx3'""",
    "lookup_2": f"""WITH {CLEAN} SELECT end_station_id, end_station_name
        FROM cleaned WHERE end_station_id = '13285'""",
    "lookup_3": f"""WITH {CLEAN} SELECT count(*) AS n FROM cleaned
        WHERE end_station_id = 'DIVVY CASSETTE REPAIR MOBILE STATION'""",
    "lookup_4": f"""WITH {CLEAN} SELECT count(*) AS n FROM cleaned
        WHERE start_station_id = 'DIVVY 001 - Warehouse test station'""",
    "keyed_trips": f"WITH {KEYED} SELECT * FROM keyed",
    "keyed_by_id": f"""WITH {KEYED}
        SELECT * EXCLUDE (trip_id), trip_id AS id FROM keyed""",
    "batches_300": f"""WITH {KEYED}
        SELECT CAST((row_number - 1) // 300 + 1 AS BIGINT) AS batch, count(*) AS n_rows,
          min(row_number) AS first_row, max(row_number) AS last_row
        FROM keyed GROUP BY 1""",
    "batches_put": f"""WITH {KEYED}
        SELECT count(*) AS n_rows, min(row_number) AS first_row, max(row_number) AS last_row
        FROM keyed GROUP BY (row_number - 1) // 300""",
    "store_text": f"WITH {STORED} SELECT * FROM stored",
    "row_range": """
        SELECT * FROM (
          SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_number FROM events)
        WHERE row_number BETWEEN 301 AND 600""",
    "row_count": "SELECT count(*) AS n FROM orders",
    "word_test_desc_top10": """
        SELECT doc_id, source, lang, n_chars FROM documents
        WHERE lower(text) LIKE '%test%' ORDER BY source DESC, doc_id LIMIT 10""",
    "union_months": "SELECT * FROM orders",
    "csv_round_trip": "SELECT * FROM orders",
    "parquet_if_absent": "SELECT * FROM orders",
    "table_scan": "SELECT * FROM orders",
    "view_scan": """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
        WHERE o_orderkey IS NOT NULL""",
    "upsert_result": LATEST_EVENTS,
    "upsert_two_writes": LATEST_WRITE,
    "keyed_upsert_read_back": LATEST_WRITE,
    "csv_rejected_rows": """
        SELECT o_orderkey, o_custkey,
          CASE WHEN o_orderkey % 50 <> 0 THEN o_totalprice END AS o_totalprice,
          o_orderkey % 50 = 0 AS rejected
        FROM orders""",
    "drop_nulls_keep_nan": """
        SELECT event_id, event_id % 7 = 0 OR isnan(value) AS is_nan FROM events
        WHERE event_id % 5 <> 0 AND (value IS NOT NULL OR event_id % 7 = 0)
          AND ts IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL AND props IS NOT NULL""",
    "lookup_checks": f"""WITH {CLEAN}
        SELECT stage, count(*) FILTER (start_station_id = 'chargingstx3') AS starred,
          count(*) FILTER (end_station_id = '13285') AS temporary,
          count(*) FILTER (end_station_id = 'DIVVY CASSETTE REPAIR MOBILE STATION') AS repair,
          count(*) FILTER (start_station_id = 'DIVVY 001 - Warehouse test station') AS warehouse
        FROM (SELECT 'before' AS stage, start_station_id, end_station_id FROM trips
          UNION ALL SELECT 'after', start_station_id, end_station_id FROM cleaned)
        GROUP BY stage""",
    "shortest_kept_rides_top6": f"""WITH {RIDES}
        SELECT ride_id, ride_length FROM rides ORDER BY ride_length, ride_id LIMIT 6""",
    "clean_trips_from_copy": f"WITH {CLEAN} SELECT * FROM cleaned",
    "upper_start_from_copy": f"""WITH {RIDES}
        SELECT * FROM rides WHERE upper(start_station_name) = start_station_name""",
    "keyed_sink_read_back": LATEST_EVENTS,
    "store_trips_read_back": f"WITH {STORED} SELECT * FROM stored",
    "keyed_sink_progress": "SELECT count(*) AS n_rows FROM events",
    "keyed_compacted_read_back": """
        SELECT * EXCLUDE (place) FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type
            ORDER BY CASE WHEN value >= 20 THEN 2 WHEN value >= 5 THEN 1 ELSE 0 END DESC, event_id DESC) AS place
          FROM events)
        WHERE place = 1""",
}
