"""Every query of the library's registry against its DuckDB oracle on sf0.001 (tests/llm has the training-data queries)."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from zpoints import queries as Q

TABLES = ["nation", "lineitem", "events", "embeddings"]


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(v))
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_registers_the_whole_registry():
    assert Q.QUERIES.keys() == Q.ORACLES.keys()
    assert Q.QUERIES.items() <= E.queries().items() and Q.ORACLES.items() <= E.oracle_sql().items()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 28


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)
