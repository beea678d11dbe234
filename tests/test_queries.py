"""Every registered query against its SQL, all columns, all rows."""

from __future__ import annotations

import pandas as pd
import pytest

import __spark_entry__ as driver
from tripmill.plans.oracle import ORACLE_SQL
from tripmill.plans.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if str(frame[name].dtype).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]")
    order = frame.astype(str).sort_values(list(frame.columns), kind="stable").index
    return frame.loc[order].reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = canonical(driver.queries()[name](spark, MIDDLE).toPandas())
    want = canonical(duck(MIDDLE).execute(driver.oracle_sql()[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.items() <= driver.queries().items()


def test_row_counts_at_the_middle_scale(spark):
    known = {
        "trips_source": 10000,
        "whitespace_rows": 7671,
        "trim_dropna": 9412,
        "short_rides": 1504,
        "long_rides": 7908,
        "clean_trips": 5410,
        "batches_300": 19,
        "upsert_result": 750,
    }
    counts = {n: driver.queries()[n](spark, MIDDLE).count() for n in known}
    assert counts == known


def test_entry(spark):
    assert driver.entry(spark).count() == 528
