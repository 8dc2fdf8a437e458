"""Every query runs, and agrees with its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from cellstride import catalog
from helpers import rows_of

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES  # the operators in llm have tests of their own


@pytest.fixture(scope="module")
def con(small):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    got = QUERIES[name](spark, small)
    if name not in ORACLES:
        assert got.count() > 0
        return
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    at = [columns.index(c) for c in sorted(columns)]

    def plain(v):
        return float(v) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    expected = sorted((tuple(plain(row[i]) for i in at) for row in result.fetchall()), key=repr)
    assert sorted((tuple(plain(v) for v in row) for row in rows_of(got, 12)), key=repr) == expected


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_contract_keys():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
