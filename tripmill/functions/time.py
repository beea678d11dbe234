"""Expressions on timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tripmill.fixed_values import SORT_KEY_FORMAT, TEXT_TIME_FORMAT
from tripmill.functions.text import column


def seconds_between(start: Column, end: Column) -> Column:
    """Difference of the two whole-second clock readings, not of the exact times."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def time_text(df: DataFrame, name: str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp column."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        # No zone is involved: formatting would first read the value in the
        # session zone and move times that fall into a clock change.
        return F.substring(column(name).cast("string"), 1, len(TEXT_TIME_FORMAT))
    return F.date_format(column(name), TEXT_TIME_FORMAT)


def time_key(df: DataFrame, name: str) -> Column:
    """``yyyyMMddHHmmss`` text, which sorts as the time does."""
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.translate(time_text(df, name), "- :", "")
    return F.date_format(column(name), SORT_KEY_FORMAT)
