"""Every registered query against its DuckDB oracle on sf0.001 (the
driver repeats this at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import canon  # noqa: E402
from wareshift.plans import QUERIES  # noqa: E402
from wareshift.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(SQL) and set(NAMES) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 25
    assert df.columns[:2] == ["r_name", "n_name"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert canon(df.columns, rows) == canon(cols, expected)
