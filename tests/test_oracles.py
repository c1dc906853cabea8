"""Every registered query against DuckDB on the same tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from rowloom.plans.table_oracles import ORACLES
from rowloom.plans.table_queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_table_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    actual = Counter(tuple(r) for r in result.select(*columns).collect())
    relation = duck.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(duck.sql(f"SELECT {quoted} FROM ({contract.oracle_sql()[name]})").fetchall())
    assert expected, "the oracle returned no rows"
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, (list(missing)[:3], list(extra)[:3])


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_order_lines_are_not_dealt_out_before_their_join(spark):
    plan = QUERIES["normalize_orders_multivalue"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan
