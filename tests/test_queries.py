"""Every registered query runs at the smallest scale and equals its SQL where it has one."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from measurekit.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

#: The forest of 200 deep trees on 64 columns takes minutes; ``MDL11_forest_on_one_feature`` and ``MDL13_classifiers_on_one_feature`` run the same code with an oracle.
LONG = set() if os.environ.get("TEST_LONG") else {"MDL11_random_forest", "MDL13_classifier_leaderboard"}


def library():
    """The library's own queries; those of the optional subpackage are tested beside it."""
    registry.load_all()
    return registry.QUERIES


pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not available")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"{float(value):.9g}" if value else "0"
    return str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_contract():
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 100
    assert set(registry.QUERIES) <= set(queries)


@pytest.mark.parametrize("name", sorted(n for n in library() if n not in LONG))
def test_query(spark, database, name):
    frame = contract.queries()[name](spark, FOLDER)
    rows = frame.collect()
    assert len(set(frame.columns)) == len(frame.columns)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = database.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert table(frame.columns, rows) == table(columns, result.fetchall())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "student_id" and frame.count() > 0
