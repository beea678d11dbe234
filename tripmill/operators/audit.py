"""Audits: what is wrong with the data, before anything is changed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.fixed_values import BLANK_FLAG_SUFFIX
from tripmill.functions.text import any_of, column, has_outer_blanks, quoted, text_columns


def with_blank_flags(df: DataFrame, suffix: str = BLANK_FLAG_SUFFIX) -> DataFrame:
    """All columns plus, per text column, whether its value has outer blanks."""
    flags = [has_outer_blanks(column(c)).alias(c + suffix) for c in text_columns(df)]
    return df.select("*", *flags)


def rows_with_outer_blanks(df: DataFrame, suffix: str = BLANK_FLAG_SUFFIX) -> DataFrame:
    return with_blank_flags(df, suffix).filter(
        any_of(column(c + suffix) for c in text_columns(df))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls in each column, all counted in one pass."""
    return df.selectExpr(
        *[f"count_if({quoted(c)} IS NULL) AS {quoted(c)}" for c in df.columns]
    )


def counts_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row: how many rows meet each condition, all counted in one pass."""
    return df.agg(*[F.count_if(condition).alias(n) for n, condition in conditions.items()])


def find_rows(
    df: DataFrame,
    where: Column,
    order_by: Sequence[str | Column] = (),
    columns: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows that meet a condition, ordered, optionally narrowed to some columns.

    End ``order_by`` with a unique column. That settles which rows a limit
    keeps, and lets the range shuffle of a full sort split a value that fills a
    large share of the rows. With a limit the sort is a top-k per task.
    """
    found = df.filter(where)
    if order_by:
        found = found.orderBy(*order_by)
    if columns is not None:
        found = found.select(*[column(c) for c in columns])
    return found if limit is None else found.limit(limit)


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column of ``df``: position, name, type, nullability."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )
