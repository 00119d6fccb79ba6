"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from placeweave.plans import catalog
from placeweave.plans.reporting import TABLES

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([_plain(row[i]) for i in order]) for row in rows)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_runs(spark):
    assert set(entry_points.entry(spark).columns) == {"contentid", "tag"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert _rows(result.columns, result.collect()) == _rows(columns, cursor.fetchall())


def test_tables_are_there(sf_dir):
    assert all(os.path.exists(f"{sf_dir}/{name}.parquet") for name in TABLES)
