from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.baselines import right_join_chain
from tidemark.operators.layout import conform
from tidemark.operators.windows import pypi_cumulative, pypi_cumulative_next
from tidemark.schemas import CUMULATIVE_DOWNLOADS

REF = date(2024, 6, 30)
SCHEMA = "download_date date, project string, project_version string, country_code string, download_count int"


def test_window_edges(spark):
    back = [0, 6, 7, 29, 30, 89, 90, 364, 365]
    rows = [(REF - timedelta(days=d), "p", "1", "US", 1) for d in back]
    rows.append((REF + timedelta(days=1), "p", "1", "US", 100))
    df = spark.createDataFrame(rows, SCHEMA)
    (row,) = pypi_cumulative(df, REF).collect()
    assert tuple(row)[4:] == (1, 2, 4, 6, 8, 109)
    (row,) = pypi_cumulative(df, str(REF), bounded_all_time=True).collect()
    assert row["download_count_since_first_record"] == 9


def test_null_keys_have_only_an_all_time_total(spark):
    df = spark.createDataFrame([(REF, "p", None, "US", 5), (REF, "p", "1", None, 6)], SCHEMA)
    shown = {tuple(r)[1:] for r in pypi_cumulative(df, REF).collect()}
    assert shown == {("p", None, "US", 0, 0, 0, 0, 0, 5), ("p", "1", None, 0, 0, 0, 0, 0, 6)}
    safe = {tuple(r)[4:] for r in pypi_cumulative(df, REF, null_safe_keys=True).collect()}
    assert safe == {(5,) * 6, (6,) * 6}


_ROW = st.tuples(
    st.integers(-3, 400).map(lambda d: REF - timedelta(days=d)),
    st.sampled_from(["a", "b", None]),
    st.sampled_from(["1", "2", None]),
    st.sampled_from(["US", None]),
    st.one_of(st.none(), st.integers(1, 50)),
)


@settings(max_examples=8, deadline=None)
@given(st.lists(_ROW, min_size=1, max_size=60))
def test_single_pass_equals_chain(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = sorted(map(tuple, pypi_cumulative(df, REF).collect()), key=repr)
    assert got == sorted(map(tuple, right_join_chain(df, REF).collect()), key=repr)
    for row in got:
        windows = row[4:9]
        assert list(windows) == sorted(windows)
        assert windows[-1] <= (row[9] or 0)


@settings(max_examples=6, deadline=None)
@given(st.lists(_ROW.filter(lambda r: r[0] <= REF), min_size=1, max_size=60))
def test_next_day_equals_recomputed(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    before = pypi_cumulative(df.where(F.col("download_date") < F.lit(REF)), REF - timedelta(days=1))
    got = sorted(map(tuple, pypi_cumulative_next(before, df, REF).collect()), key=repr)
    assert got == sorted(map(tuple, pypi_cumulative(df, REF).collect()), key=repr)


def test_sums_that_do_not_fit_fail(spark):
    df = spark.createDataFrame([(REF, "p", "1", "US", 2_000_000_000)] * 2, SCHEMA)
    rollup = pypi_cumulative(df, REF)
    assert rollup.first()["download_count"] == 4_000_000_000
    with pytest.raises(Exception, match="OVERFLOW"):
        conform(rollup, CUMULATIVE_DOWNLOADS.schema).collect()
    assert conform(rollup, CUMULATIVE_DOWNLOADS.widened().schema).count() == 1


def test_one_shuffle(spark):
    df = spark.createDataFrame([(REF, "p", "1", "US", 1)], SCHEMA)
    plan = pypi_cumulative(df, REF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
