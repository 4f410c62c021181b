"""Every registered query against its SQL on the smallest data."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def in_order(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    from conftest import DATA

    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    frame = QUERIES[name](spark, data)
    columns = sorted(frame.columns)
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    if name not in ORACLES:
        assert got
        return
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = [tuple(r[i] for i in order) for r in answer.fetchall()]
    assert in_order(got) == in_order(want)


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["qid", "question", "context", "num_sources"]
    assert frame.count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
