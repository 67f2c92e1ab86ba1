"""Every registered query against its SQL on an independent engine."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from feira.plans.star_oracle import ORACLE
from feira.plans.star_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def by_name(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    # As text, so that 1 and 1.0 differ.
    picked = sorted(repr(tuple(row[i] for i in order)) for row in found)
    return [columns[i] for i in order], picked


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, engine, name):
    df = QUERIES[name](spark, FOLDER)
    expected = engine.sql(ORACLE[name])
    assert by_name(df.columns, df.collect()) == by_name(expected.columns, expected.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).columns == ["customer_state", "total_sales", "customer_state_name"]
    assert contract.entry(spark).count() > 0
