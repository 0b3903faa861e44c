"""Every query with a SQL twin gives the twin's rows."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in data)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, name):
    got = queries()[name](spark, sf_dir)
    want = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_queries_without_twin(spark, sf_dir):
    for name in set(queries()) - set(oracle_sql()):
        assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 4
