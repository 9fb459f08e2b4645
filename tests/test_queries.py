"""Every registered query against its DuckDB counterpart, on whole tables."""

import importlib
from pathlib import Path

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
entry = importlib.import_module("__spark_entry__")
OWN = {name for module in ("parsing", "grouping", "pages", "answers", "output") for name in importlib.import_module(f"checks.{module}").QUERIES}
RUN = {name: run for name, run in entry.queries().items() if name in OWN}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(RUN))
def test_query(spark, duck, name):
    df = RUN[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([row[c] for c in columns]) for row in df.collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(RUN) == set(SQL)
