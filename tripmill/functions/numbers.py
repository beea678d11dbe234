"""Expressions on numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_text(number: Column) -> Column:
    """Decimal notation of a number as text.

    Spark's own text of a double has an exponent below 0.001 and from ten
    million on. Decimal notation keeps plain digits from 0.000001 up to 1e16,
    and beyond that writes an exponent without a needless ``.0``. The magnitudes
    of decimal(38,22) cover the plain range without losing a digit.
    """
    text = number.cast("double").cast("string")
    size = F.abs(number.cast("double"))
    plain = F.regexp_replace(
        number.cast("double").try_cast("decimal(38,22)").cast("string"), r"(\.\d+?)0*$", "$1"
    )
    exponent = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "E+$1")
    return (
        F.when(~text.contains("E"), text)
        .when((size >= 1e-6) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def sequence_key(number: Column, prefix: str, digits: int) -> Column:
    """Prefix and zero-padded number; a number with more digits is kept whole."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{digits}d", number))


def batch_number(row_number: Column, batch_rows: int) -> Column:
    """1-based number of the run of ``batch_rows`` consecutive rows."""
    return F.call_function("div", row_number - 1, F.lit(batch_rows)) + 1
