"""Results depend on these exact words, patterns and formats."""

from __future__ import annotations

# --- Fixed values, as plain text -------------------------------------------
MIN_RIDE_SECONDS = 60
TEST_WORD = "test"
TEMP_WORD = "temp"
OPERATOR_WORD = "DIVVY"
REPAIR_STATION = "divvy cassette repair mobile station"
ASTERISK_PATTERN = r"\s?\*"
TEMP_PATTERN = r"\s?\(Temp\)"
BLANK_FLAG_SUFFIX = "_has_whitespace"
RESCUED_COLUMN = "_rescued_data"
MONTHS = ("01", "02", "03", "04", "05", "06", "07", "08", "09", "10", "11", "12")
MONTH_FILE = "divvy_tripdata_{year}{month}.csv"
TRIP_PREFIX = "TRIP_"
TRIP_DIGITS = 7
SORT_KEY_FORMAT = "yyyyMMddHHmmss"
TEXT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
BATCH_ROWS = 300
WRITE_TRIES = 5
WRITE_DELAY_SECONDS = 2
WRITE_BACKOFF = 2
# ---------------------------------------------------------------------------
