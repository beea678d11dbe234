"""Catalog tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.fixed_values import RESCUED_COLUMN


def read_table(spark: SparkSession, name: str, drop: str = RESCUED_COLUMN) -> DataFrame:
    """A catalog table without the reader's bookkeeping column, if it has one."""
    return spark.table(name).drop(drop)


def query_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Publish ``df`` as a session view and run SQL over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(sql)
