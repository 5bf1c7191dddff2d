"""Every registered query that has SQL gives the same rows as DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


def rows(frame):
    def plain(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) == "<NA>":
            return None
        return float(x) if isinstance(x, (int, float)) else str(x)

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = QUERIES[name](spark, str(FOLDER)).toPandas()
    expected = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows(got) == rows(expected)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
