"""Every registered query against its SQL, run independently by DuckDB."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def in_order(rows, columns):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(row[n] for n in order) for row in rows), key=str)


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1.5e-6)
    return left == right


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    found = in_order([tuple(row) for row in result.collect()], result.columns)
    cursor = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    expected = in_order(cursor.fetchall(), columns)
    assert sorted(result.columns) == sorted(columns)
    assert len(found) == len(expected)
    for left, right in zip(found, expected):
        assert all(same(a, b) for a, b in zip(left, right)), (left, right)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
