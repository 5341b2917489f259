"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_file
from litsieve.plans import oracle
from litsieve.plans.queries import queries as digest_queries

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


def test_every_query_has_sql():
    assert set(digest_queries()) == set(oracle.oracle_sql())
    assert set(digest_queries()) <= set(entry_file.queries())


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(digest_queries()))
def test_query(spark, duck, name):
    result = entry_file.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in result.collect()]
    answer = duck.execute(entry_file.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = [tuple(plain(r[i]) for i in places) for r in answer.fetchall()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
