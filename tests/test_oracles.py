"""Every query against its SQL twin on the smallest test data."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(entry.ORACLES) & set(entry.oracle_sql())))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = table(df.collect(), df.columns)
    assert got
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
