"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered
from keybrook.plans import registry

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no sample tables")

QUERIES, ORACLES = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def multiset(names, rows):
    order = sorted(range(len(names)), key=lambda index: names[index])
    return Counter(
        tuple(
            round(row[index], 9) if isinstance(row[index], float) and math.isfinite(row[index])
            else row[index]
            for index in order
        )
        for row in rows
    )


def test_every_query_has_its_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(ORACLES) <= set(QUERIES) and set(registry.QUERIES) <= set(QUERIES)


def test_entry(spark):
    assert registered.entry(spark).count() == 6000


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query_equals_its_sql(spark, database, name):
    frame = QUERIES[name](spark, str(FOLDER))
    result = database.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    ours = multiset(frame.columns, (tuple(row) for row in frame.collect()))
    assert ours == multiset(columns, result.fetchall())
    assert ours
