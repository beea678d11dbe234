"""The form in which trips go to a key-value store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.fixed_values import BATCH_ROWS
from tripmill.functions.numbers import batch_number, decimal_text
from tripmill.functions.text import column
from tripmill.functions.time import time_text


def values_as_text(
    df: DataFrame,
    times: Sequence[str] = ("started_at", "ended_at"),
    numbers: Sequence[str] = ("start_lat", "start_lng", "end_lat", "end_lng"),
) -> DataFrame:
    """Timestamps and decimals as text, for stores that have neither type."""
    return df.withColumns(
        {
            **{c: time_text(df, c) for c in times},
            **{c: decimal_text(column(c)) for c in numbers},
        }
    )


def with_batch(
    numbered: DataFrame,
    batch_rows: int = BATCH_ROWS,
    number: str = "row_number",
    name: str = "batch",
) -> DataFrame:
    return numbered.withColumn(name, batch_number(column(number), batch_rows))


def batch_summary(
    numbered: DataFrame, batch_rows: int = BATCH_ROWS, number: str = "row_number"
) -> DataFrame:
    """Per batch: its row count and its lowest and highest row number."""
    return (
        with_batch(numbered, batch_rows, number)
        .groupBy("batch")
        .agg(
            F.count("*").alias("n_rows"),
            F.min(column(number)).alias("first_row"),
            F.max(column(number)).alias("last_row"),
        )
    )
