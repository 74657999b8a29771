"""Table sets, replication rules, date series and object listings."""

import json
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import types as T

from daybook.sources import (
    SOURCE_SCHEMAS,
    TableSet,
    apply_rules,
    bank_tables,
    calendar,
    date_spine,
    inventory,
    inventory_summary,
    observed_spine,
    parse_rules,
    require_schema,
)


def rule(table, filters=(), **changes):
    body = {
        "rule-type": "selection",
        "rule-action": "include",
        "object-locator": {"schema-name": "public", "table-name": table},
    }
    if filters:
        body["filters"] = [
            {"filter-type": "source", "column-name": c, "filter-conditions": [{"filter-operator": op}]}
            for c, op in filters
        ]
    return {**body, **changes}


def rules(*items):
    return parse_rules(json.dumps({"rules": items}))


@pytest.fixture
def tables(spark):
    txn = spark.createDataFrame([(1, None, None), (2, "X", None), (3, None, "t")], "id int, status string, deletedAt string")
    return {"txn": txn, "txn_info": txn.select("id"), "other": txn.select("id")}


def test_rules_select_and_filter(tables):
    selected = apply_rules(tables, rules(rule("other"), rule("TXN", [("status", "null"), ("deletedat", "null")])))
    assert {name: rows(df.select("id")) for name, df in selected.items()} == {
        "other": [(1,), (2,), (3,)],
        "txn": [(1,)],
    }


def test_wildcard_rules(tables):
    assert set(apply_rules(tables, rules(rule("%")))) == set(tables)
    assert set(apply_rules(tables, rules(rule("txn%")))) == {"txn", "txn_info"}
    assert apply_rules(tables, rules(rule("nothing%"))) == {}


def test_rules_that_cannot_be_met_are_refused(tables):
    with pytest.raises(KeyError, match="absent"):
        apply_rules(tables, rules(rule("absent")))
    with pytest.raises(ValueError, match="include"):
        rules(rule("t", **{"rule-action": "exclude"}))
    with pytest.raises(ValueError, match="null filters"):
        rules(rule("t", [("c", "eq")]))


def test_tables_open_once_and_on_demand(spark):
    opened = []

    def open_table(name):
        opened.append(name)
        return spark.range(1)

    tables = TableSet(open_table, lambda: ["a", "b"])
    assert tables["a"] is tables["a"] and opened == ["a"]
    assert list(tables) == ["a", "b"] and len(tables) == 2


def test_tables_of_a_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.range(3).write.mode("overwrite").saveAsTable("shop.items")
    tables = TableSet.from_database(spark, "shop")
    assert list(tables) == ["items"] and tables["items"].count() == 3


def test_tables_of_a_directory(spark, data):
    tables = TableSet.from_directory(spark, data)
    assert "orders" in list(tables) and tables["nation"].count() == 25


def test_required_schema(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id int, name string, more int")
    fits = T.StructType([T.StructField("name", T.StringType()), T.StructField("id", T.IntegerType())])
    assert require_schema(df, fits, "t").columns == ["name", "id"]
    broken = T.StructType([T.StructField("id", T.LongType()), T.StructField("gone", T.StringType())])
    with pytest.raises(ValueError, match="id: expected bigint, found int; gone: expected string, found nothing"):
        require_schema(df, broken, "t")


def test_bank_tables_fit_their_declared_schemas(spark, data):
    tables = bank_tables(spark, data).checked(SOURCE_SCHEMAS)
    for name in SOURCE_SCHEMAS:
        assert tables[name].columns
    wrong = TableSet.from_frames({"role": spark.range(1)}).checked(SOURCE_SCHEMAS)
    with pytest.raises(ValueError, match="source role"):
        wrong["role"]


def test_spines(spark):
    days = [(date(2024, 2, 28),), (date(2024, 2, 29),), (date(2024, 3, 1),)]
    assert rows(date_spine(spark, days[0][0], days[-1][0])) == days
    assert rows(observed_spine(spark.createDataFrame([days[2], days[0]], "d date"), "d")) == days


@pytest.mark.parametrize("as_of, first, last, count", [
    (date(2024, 2, 29), date(2022, 2, 28), date(2026, 2, 28), 1462),
    (date(2023, 3, 1), date(2021, 3, 1), date(2025, 3, 1), 1462),
])
def test_calendar_spans_two_years_each_way(spark, as_of, first, last, count):
    result = rows(calendar(spark.createDataFrame([(as_of,), (date(2000, 1, 1),)], "as_of date")))
    assert len(result) == count and (result[0][1], result[-1][1]) == (first, last)
    assert result[0] == (first.year * 10000 + first.month * 100 + first.day, first, first.day, first.month, first.year)


def test_inventory(spark, tmp_path):
    for key, size in {"a/one.bin": 3, "a/b/two.bin": 5, "ab.txt": 1, "c.bin": 7}.items():
        path = tmp_path / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    sizes = lambda prefix: {r.key: r.size for r in inventory(spark, str(tmp_path), prefix).collect()}
    assert sizes("") == {"a/one.bin": 3, "a/b/two.bin": 5, "ab.txt": 1, "c.bin": 7}
    assert sizes("a") == {"a/one.bin": 3, "a/b/two.bin": 5, "ab.txt": 1}
    assert sizes("a/") == {"a/one.bin": 3, "a/b/two.bin": 5}
    assert sizes("a/b/t") == {"a/b/two.bin": 5}
    assert sizes("gone/x") == {}
    summary = inventory_summary(inventory(spark, f"file://{tmp_path}", "a/"), "here", "a/")
    assert rows(summary) == [("here", "a/", 2, 8)]
    assert rows(inventory_summary(inventory(spark, str(tmp_path), "gone/"), "here", "gone/")) == [("here", "gone/", 0, 0)]


def test_rules_of_another_schema_select_nothing(spark):
    tables = {"orders": spark.range(1)}

    def rule(schema, table):
        locator = {"schema-name": schema, "table-name": table}
        return json.dumps({"rules": [{"rule-type": "selection", "rule-action": "include", "object-locator": locator}]})

    assert apply_rules(tables, parse_rules(rule("nope", "%"))) == {}
    assert list(apply_rules(tables, parse_rules(rule("nope", "%")), schema="nope")) == ["orders"]
    assert list(apply_rules(tables, parse_rules(rule("pub%", "ord%")))) == ["orders"]
    with pytest.raises(KeyError, match="nope.orders"):
        apply_rules(tables, parse_rules(rule("nope", "orders")))
