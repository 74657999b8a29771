"""Upsert, constraints, reconciliation, dictionary and column helpers on a handful of rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook import operators as ops
from daybook.functions import iso_timestamp, lifecycle_status, money, prefixed_key
from daybook.plans import TARGETS, conform
from daybook.sinks.items import to_item

PAIR = "id int, v string"


def frame(spark, data, schema=PAIR):
    return spark.createDataFrame(data, schema)


# --- columns -------------------------------------------------------------------------------------


def test_columns(spark):
    df = frame(
        spark,
        [(1, "12.345", datetime(2024, 1, 2, 3, 4, 5)), (None, "x", datetime(2024, 1, 2, 3, 4, 5, 60)), (2, None, None)],
        "id int, amount string, ts timestamp_ntz",
    )
    result = df.select(prefixed_key("SUB", "id"), money("amount"), lifecycle_status("ts"), iso_timestamp("ts"))
    assert [tuple(r) for r in result.collect()] == [
        ("SUB1", Decimal("12.35"), "INACTIVE", "2024-01-02T03:04:05"),
        (None, None, "INACTIVE", "2024-01-02T03:04:05.000060"),
        ("SUB2", None, "ACTIVE", None),
    ]


# --- upsert --------------------------------------------------------------------------------------


def test_upsert_takes_source_nulls_and_deletes_nothing(spark):
    target = frame(spark, [(1, "a"), (2, "b"), (3, "c"), (None, "n")])
    source = frame(spark, [(2, None), (3, "C"), (4, "d")])
    assert rows(ops.upsert(target, source)) == rows(
        frame(spark, [(1, "a"), (2, None), (3, "C"), (4, "d"), (None, "n")])
    )


def test_upsert_follows_the_targets_columns(spark):
    source = frame(spark, [("x", 1)], "v string, id int")
    assert ops.upsert(frame(spark, [(1, "a")]), source).columns == ["id", "v"]


def test_upsert_scans_each_input_once(spark, tmp_path):
    for name, rows_ in (("target", 100_000), ("changes", 10)):
        spark.range(rows_).selectExpr("id", "'v' as v").write.parquet(str(tmp_path / name))
    target, changes = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "changes"))
    plan = physical_plan(ops.upsert(target, ops.latest_version(changes, "id", ["v"])))
    assert plan.count("FileScan") == 2 and plan.count("FullOuter") == 1


def test_upsert_refuses_or_adds_new_columns(spark):
    target, source = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "B", 7)], "id int, v string, extra int")
    with pytest.raises(ValueError, match="extra"):
        ops.upsert(target, source)
    assert rows(ops.upsert(target, source, new_columns="add")) == [(1, "a", None), (2, "B", 7)]


def test_upsert_takes_missing_columns_as_null_and_keeps_all_null_keys(spark):
    target = frame(spark, [(1, "a"), (None, "n"), (None, "n")])
    assert rows(ops.upsert(target, frame(spark, [(1,), (None,)], "id int"))) == rows(
        frame(spark, [(1, None), (None, "n"), (None, "n"), (None, None)])
    )


KEYED = st.dictionaries(st.integers(0, 8), st.none() | st.sampled_from("xyz"), max_size=8)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=KEYED, source=KEYED)
def test_upsert_and_insert_equal_dict_updates(spark, target, source):
    old, new = frame(spark, list(target.items())), frame(spark, list(source.items()))
    merged = ops.upsert(old, new)
    assert dict(rows(merged)) == {**target, **source}
    assert merged.count() == len(target | source)
    assert rows(ops.upsert(merged, new)) == rows(merged)
    assert dict(rows(ops.insert_if_absent(old, new))) == {**source, **target}


def test_insert_takes_one_row_of_a_repeated_new_key(spark):
    schema = "id int, at int, v string"
    target = frame(spark, [(1, 0, "old"), (None, 0, "n")], schema)
    batch = [(1, 0, "x"), (2, 2, "late"), (2, 1, "b"), (2, 1, "a"), (2, None, "undated"), (3, None, None), (None, 1, "k"), (None, 1, "k")]
    result = ops.insert_if_absent(target, frame(spark, batch, schema), order=["at"])
    assert rows(result) == rows(
        frame(spark, [(1, 0, "old"), (2, 1, "a"), (3, None, None), (None, 0, "n"), (None, 1, "k"), (None, 1, "k")], schema)
    )
    assert ops.insert_if_absent(target, frame(spark, [(2, 1, "a"), (2, 1, "a")], schema)).count() == 3


def test_insert_reads_each_side_once(spark, tmp_path):
    for name in ("target", "batch"):
        frame(spark, [(1, "a")]).write.parquet(str(tmp_path / name))
    target, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "batch"))
    plan = physical_plan(ops.insert_if_absent(target, batch))
    assert plan.count("FileScan") == 2


def test_latest_version(spark):
    changes = frame(spark, [(1, 1, "a"), (1, 2, None), (2, None, "old"), (2, 0, "new")], "id int, at int, v string")
    assert rows(ops.latest_version(changes, "id", ["at"])) == [(1, 2, None), (2, 0, "new")]


def test_split_null_keys(spark):
    keyed, rejected = ops.split_null_keys(frame(spark, [(1, "a"), (None, "b")]), "id")
    assert rows(keyed) == [(1, "a")] and rows(rejected) == [(None, "b")]


# --- constraints ---------------------------------------------------------------------------------


def test_primary_key_finds_repeats_and_nulls(spark):
    df = frame(spark, [(1, "a"), (1, "a"), (2, "a"), (None, "a")])
    assert rows(ops.check_primary_key(df, ["id", "v"])) == [(None, "a", 1), (1, "a", 2)]


def test_unique_ignores_nulls(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (None, "a"), (None, "b")])
    assert rows(ops.check_unique(df, ["id"])) == [(1, 2)]


def test_not_null_counts_each_column(spark):
    df = frame(spark, [(1, None), (None, None), (2, "a")])
    assert rows(ops.check_not_null(df, ["id", "v"])) == [("id", 1), ("v", 2)]


def test_foreign_key_passes_keys_with_a_null_part(spark):
    child = frame(spark, [(1, "a"), (1, "b"), (1, "b"), (None, "z"), (9, None)])
    parent = frame(spark, [(1, "a"), (1, "a"), (2, "b")], "pid int, pv string")
    assert rows(ops.check_foreign_key(child, ["id", "v"], parent, ["pid", "pv"])) == [(1, "b", 2)]


def test_rejects_name_their_empty_columns(spark):
    accepted, rejected = ops.split_rejects(frame(spark, [(1, "a"), (None, None), (2, None)]), ["id", "v"])
    assert rows(accepted) == [(1, "a")]
    assert rows(rejected) == [(None, None, "id,v"), (2, None, "v")]


def test_defaults_fill_absent_columns_only(spark):
    target = TARGETS["fact_transactions"]
    absent = conform(frame(spark, [("1", 1)], "transaction_id string, client_id int"), target).first()
    assert (absent.currency, absent.amount) == ("USD", None)
    given_null = frame(spark, [("1", None)], "transaction_id string, currency string")
    assert conform(given_null, target).first().currency is None
    with pytest.raises(ValueError, match="no column colour"):
        conform(frame(spark, [("red",)], "colour string"), target)


# --- reconcile -----------------------------------------------------------------------------------


def report(spark, actual, expected):
    schema = "id int, a string, b double"
    result = ops.reconcile(frame(spark, actual, schema), frame(spark, expected, schema), ["id"], ["a", "b"])
    return {(r.metric, r.column_name): r.n for r in result.collect()}


def test_reconcile_counts_each_kind_of_difference(spark):
    actual = [(1, "x", 1.0), (2, "y", 2.0), (3, None, None), (4, "only", 0.0), (6, "d", 0.0), (6, "d", 0.0), (None, "n", 0.0)]
    expected = [(1, "x", 1.0), (2, "Y", None), (3, None, 0.0), (5, "only", 0.0), (6, "d", 0.0), (None, "n", 0.0)]
    assert report(spark, actual, expected) == {
        ("missing", None): 1,
        ("unexpected", None): 1,
        ("duplicate", None): 1,
        ("compared", None): 4,
        ("mismatch", "a"): 1,
        ("mismatch", "b"): 2,
    }


def test_reconcile_equal_sides(spark):
    same = [(i, "x", 1.0) for i in range(5)]
    counts = report(spark, same, same)
    assert counts.pop(("compared", None)) == 5 and set(counts.values()) == {0}


def test_reconcile_compares_values_of_like_types(spark):
    actual = frame(spark, [(1, 5, Decimal("1.50")), (2, 6, None)], "id int, n int, x decimal(18,2)")
    expected = frame(spark, [(1, 5, Decimal("1.5")), (2, 7, Decimal("0"))], "id bigint, n bigint, x decimal(20,4)")
    result = ops.reconcile(actual, expected, ["id"], ["n", "x"])
    found = {(r.metric, r.column_name): r.n for r in result.collect() if r.n}
    assert found == {("compared", None): 2, ("mismatch", "n"): 1, ("mismatch", "x"): 1}


def test_reconcile_sorts_no_rows(spark):
    side = frame(spark, [(1, "x", "y")], "id int, a string, b string")
    plan = physical_plan(ops.reconcile(side, side, ["id"], ["a", "b"]))
    assert "SortAggregate" not in plan and "Sort " not in plan and "HashAggregate" in plan


# --- dictionary ----------------------------------------------------------------------------------


def test_dictionary_items(spark):
    kinds = frame(
        spark,
        [(7, "x", 0.1, True, datetime(2024, 1, 1, 5)), (None, None, None, None, None)],
        "id int, name string, rate double, open boolean, since timestamp_ntz",
    )
    days = frame(spark, [("a", date(2024, 1, 1))], "id string, day date")
    items = {r.id: to_item(r) for r in ops.dictionary_items({"kind": kinds, "day": days}).collect()}
    assert items == {
        "kind7": {
            "id": "kind7", "source_id": "7", "source_table": "kind",
            "name": "x", "rate": Decimal("0.1"), "open": True, "since": "2024-01-01T05:00:00",
        },
        "kind": {"id": "kind", "source_id": "", "source_table": "kind"},
        "daya": {"id": "daya", "source_id": "a", "source_table": "day", "day": "2024-01-01"},
    }
