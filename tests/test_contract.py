"""The driver contract and Spark-vs-DuckDB parity on the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as E
from martlet.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "order_id" and len(df.columns) == 15
    assert df.count() == 1454


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        return repr(round(v, 6)) if isinstance(v, float) else str(v)
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_parity(spark, con, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.execute(catalog.ORACLE_SQL[name])
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _canon(df.columns, s_rows) == _canon(d_cols, d_rows)
