"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# the training-data subpackage tests its own queries
OWN = sorted(set(entry.queries()) - set(entry._LLM_QUERIES))


def _norm(v):
    if isinstance(v, float):
        return repr(v)  # strict: -0.0 and 0.0 differ, as in a value hash
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry._LLM_SQL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_every_statement_can_be_a_view(con, name):
    con.execute(f"CREATE OR REPLACE TEMP VIEW probe AS {entry.oracle_sql()[name]}")
    con.execute("SELECT * FROM probe LIMIT 0")


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["metric_date", "gmv"] and df.count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, cur.fetchall())
