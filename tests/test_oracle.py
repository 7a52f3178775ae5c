"""Every registered query against its DuckDB statement on sf0.001 (the
driver repeats this at sf0.01): row count, column names and an
order-insensitive value hash must agree; queries without SQL must run."""

import duckdb
import pytest

import __spark_entry__ as E
from rewardframe.sources.tables import TABLES
from tests.conftest import SF001
from tools_check import digest, norm

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 90


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sp = norm(QUERIES[name](spark, SF001).toPandas())
    if name not in SQL:
        assert len(sp.columns) > 0
        return
    dk = norm(con.execute(SQL[name]).df())
    assert list(sp.columns) == list(dk.columns)
    assert len(sp) == len(dk)
    assert digest(sp) == digest(dk)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "reward_mean" in df.columns
