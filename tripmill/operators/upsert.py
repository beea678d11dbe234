"""Keyed tables: a later row replaces the earlier one of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.text import column, quoted


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Per key the row that comes last by ``order_by``.

    An aggregate rather than a window: each task keeps one row per key before
    the shuffle, so a key with a third of all rows sends one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    last = F.max_by(
        F.struct(*[column(c) for c in others]), F.struct(*[column(c) for c in order_by])
    )
    picked = df.groupBy(*[column(k) for k in keys]).agg(last.alias("__last"))
    return picked.select(
        *[
            column(c) if c in keys else F.col("__last").getField(c).alias(c)
            for c in df.columns
        ]
    )


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """``target``, one row per key, after writing ``batch`` over it; null keys are equal.

    Rows of the target whose key is not in the batch pass through: only they and
    the batch keys meet in a join, whose strategy Spark picks by their size.
    Neither side repeats a key by then, so the join has no hot key.
    """
    newest = latest_by_key(batch, keys, order_by)
    asked = newest.select(*[column(k).alias(f"__{i}") for i, k in enumerate(keys)])
    same = [target[quoted(k)].eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    return target.join(asked, same, "left_anti").unionByName(newest)
