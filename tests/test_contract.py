"""Every contract query against its SQL, on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert contract.QUERIES.keys() == contract.ORACLES.keys()


# One folder a day for 2,500 days: minutes of small files; users, products and payments stay.
MANY_DAYS = {"stream_fanout_transactions", "stream_fanout_shippings"}


@pytest.mark.parametrize("name", [name for name in contract.QUERIES if name not in MANY_DAYS])
def test_query_equals_its_sql(spark, sql, name):
    result = contract.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    expected = sql.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]}) AS q")
    assert sorted(d[0] for d in expected.description) == columns
    actual = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(actual, key=repr) == sorted(expected.fetchall(), key=repr)
    assert actual


def test_entry(spark):
    assert contract.entry(spark).count() > 0
