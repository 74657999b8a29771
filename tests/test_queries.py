"""Every named query against its SQL counterpart, and how each plan looks."""

from decimal import Decimal

import duckdb
import pytest
from conftest import physical_plan

import __spark_entry__ as entry_points
from daybook import operators as ops
from daybook.catalogue import catalogue
from daybook.oracle import GIVEN_TABLES, oracles

QUERIES, ORACLES = catalogue(), oracles()


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for table in GIVEN_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    return connection


def comparable(value):
    """Decimals stay apart from floats, and by value from each other whatever their scale."""
    return ("decimal", str(value.normalize())) if isinstance(value, Decimal) else value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([comparable(row[i]) for i in order]) for row in data)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.fixture(scope="module")
def built(spark, data):
    """Query frames, each made once."""
    frames = {}

    def get(name):
        if name not in frames:
            frames[name] = QUERIES[name](spark, data)
        return frames[name]

    return get


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(built, duck, name):
    df = built(name)
    cursor = duck.execute(ORACLES[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_jvm_without_cross_products(built, name):
    plan = physical_plan(built(name))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["fact_ordered", "audit_fact"])
def test_ordered_facts_are_in_order(built, name):
    keys = [(r.subaccount_id, r.date) for r in built(name).collect()]
    assert keys == sorted(keys)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 10 * 2469 + 15 * 28


def test_null_filters_reach_the_scan(spark, tmp_path):
    txns = spark.createDataFrame([(1, None, None)], "id int, status string, deleted_at timestamp_ntz")
    txns.write.parquet(str(tmp_path / "txns"))
    plan = physical_plan(ops.posted(spark.read.parquet(str(tmp_path / "txns"))))
    assert "PushedFilters: [IsNull(status), IsNull(deleted_at)]" in plan


def test_scan_reads_only_needed_columns(built):
    plan = physical_plan(built("active_entities"))
    assert "l_extendedprice" not in plan
