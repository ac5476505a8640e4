"""Every registered query against its SQL restatement, value by value."""

import math
import os
import time

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("QUIRE_TEST_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return bytes(value) if isinstance(value, bytearray) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    started = time.time()
    frame = contract.queries()[name](spark, SF_DIR)
    found = [tuple(row) for row in frame.collect()]
    print(f"{name}: {len(found)} rows, {time.time() - started:.2f}s")
    assert found, "a registered query gives rows"
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return
    answer = duck.execute(sql)
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = rows_of(columns, answer.fetchall())
    actual = rows_of(frame.columns, found)
    assert len(actual) == len(expected)
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not different, f"{len(different)} of {len(actual)} rows differ; first: {str(different[0])[:600]}"
