"""Every registered query against its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.registry import ORACLE as SQL
from checks.registry import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = _rows(df.columns, df.collect())
    assert got
    if name in SQL:
        cursor = con.execute(SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert got == _rows(names, cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries())
    assert set(SQL) <= set(oracle_sql())
