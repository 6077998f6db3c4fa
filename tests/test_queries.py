"""Every registered query against its SQL on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, duck, name):
    found = contract.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in found.collect())
    answer = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    wanted = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall())
    assert got == wanted
