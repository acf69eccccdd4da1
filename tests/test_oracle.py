"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

from transitloom.plans.oracle import all_oracles
from transitloom.plans.queries import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _table(names, records):
    places = [names.index(name) for name in sorted(names)]
    return sorted(tuple(_value(record[i]) for i in places) for record in records)


def test_every_oracle_has_its_query():
    assert set(all_oracles()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, duck, name):
    found = all_queries()[name](spark, SF)
    expected = duck.sql(all_oracles()[name])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(slow in plan for slow in ("Cartesian", "NestedLoop", "Python"))
    kinds = {column: TYPES[kind] for column, kind in found.dtypes}
    assert kinds == dict(zip(expected.columns, map(str, expected.types)))
    assert _table(found.columns, found.collect()) == _table(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_oracles())))
def test_query_without_sql_has_rows(spark, name):
    assert all_queries()[name](spark, SF).count() > 0
