"""Each registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import duckdb
import pytest

import __spark_entry__ as E
from support import SF01
from tools.oracle_check import TABLES, digest

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) >= 1
        return
    cur = con.execute(SQL[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    # exact values: both sides round to 6 places themselves
    assert digest(df.columns, rows, strict=True) == digest(ocols, orows, strict=True)


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.columns == ["category", "count", "avg_normalized", "avg_original"]
    assert out.count() == 3
