"""Fills by ranges against a walk through each series, and items published with a record."""

import json
import os
import random
from pathlib import Path

import pytest
from conftest import physical_plan

from daybook import operators as ops
from daybook.operators import scans
from daybook.sinks import publish
from daybook.sinks.publication import record_id

SCHEMA = "entity string, at int, balance int, note string"


def walked(data, fill):
    """Each row's filled value, by definition."""
    out, so_far = [], {}
    last = float("inf")
    for entity, at, balance, note in sorted(
        data, key=lambda r: (last if r[1] is None else r[1], r[2] is not None, r[2] or 0)
    ):
        earlier = so_far.get(entity)
        if balance is not None:
            so_far[entity] = balance if fill == "last" or earlier is None else max(earlier, balance)
            out.append((entity, at, balance, note))
        else:
            out.append((entity, at, 0 if earlier is None else earlier, note))
    return sorted(out, key=repr)


def series(seed, rows, entities=("a", "b", None)):
    draw = random.Random(seed)
    return [
        (draw.choice(entities), draw.choice([None, *range(rows // 4)]), draw.choice([None, None, None, draw.randint(-9, 99)]), draw.choice("xy"))
        for _ in range(rows)
    ]


FILLS = {"last": ops.forward_fill_ranges, "max": ops.running_max_ranges}
CASES = {
    "three series with ties and nulls": series(1, 400),
    "one series holds nearly all": series(2, 300, ("a",)) + [("b", 3, None, "x"), ("c", 1, 7, "x")],
    "rows all alike": [("a", 1, 5, "x")] * 50 + [("a", 1, None, "y")] * 50 + [("a", 2, None, "y")] * 20,
    "a value long ago": [("a", 0, 42, "x")] + [("a", i, None, "x") for i in range(1, 200)],
    "no value ever": [("a", i, None, "x") for i in range(40)],
    "empty": [],
}


@pytest.mark.parametrize("fill", sorted(FILLS))
@pytest.mark.parametrize("case", sorted(CASES))
def test_fill_by_ranges_equals_a_walk(spark, case, fill):
    df = spark.createDataFrame(CASES[case], SCHEMA)
    for ranges in (1, 7):
        got = FILLS[fill](df, "entity", "balance", ("at",), ranges=ranges)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect()), key=repr) == walked(CASES[case], fill)


def test_one_series_lies_in_all_ranges(spark):
    df = spark.range(1000).selectExpr("'a' as entity", "cast(id as int) as at", "if(id % 9 = 0, int(id), null) as balance", "'x' as note")
    ranged = scans._ranged(df, "entity", "balance", ("at",), 8)
    sizes = [r["count"] for r in ranged.groupBy("__range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 300
    # What is broadcast has less than a row for each range, and no window is over the entity's rows.
    assert scans._carried(ranged, "entity", scans.F.max("balance"), scans.F.max).count() == 7
    plan = physical_plan(ops.forward_fill_ranges(df, "entity", "balance", ("at",), ranges=8))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def file_store(folder, broken=None):
    """A store whose items are files; putting the item ``broken`` fails."""

    def connect():
        def put(batch):
            for item in batch:
                if item["id"] == broken:
                    raise OSError("store refuses")
                path = Path(folder) / item["id"].replace("/", "_")
                part = path.with_suffix(f".{os.getpid()}")
                part.write_text(json.dumps(item, default=str))
                part.rename(path)

        return put

    return connect


def stored(folder, item):
    path = Path(folder) / item.replace("/", "_")
    return json.loads(path.read_text()) if path.exists() else None


def kinds(spark, rows):
    return ops.dictionary_items(
        {
            "kind": spark.range(rows).selectExpr("id", "concat('k', id) as name").repartition(3),
            "sort": spark.range(2).selectExpr("id", "1.5 as share"),
        }
    )


def test_a_publication_is_recorded_after_all_its_items(spark, tmp_path):
    for _ in range(2):  # repeating it changes nothing
        publish(kinds(spark, 60), file_store(str(tmp_path)), "2024-02-01", batch_size=7)
        record = stored(tmp_path, record_id("2024-02-01"))
        assert (record["state"], record["items"]) == ("committed", {"kind": 60, "sort": 2})
        assert stored(tmp_path, "kind17") == {"name": "k17", "id": "kind17", "source_id": "17", "source_table": "kind"}
        assert len(list(tmp_path.iterdir())) == 63


def test_a_failing_task_leaves_an_aborted_record(spark, tmp_path):
    publish(kinds(spark, 5), file_store(str(tmp_path)), "old")
    with pytest.raises(Exception, match="store refuses"):
        publish(kinds(spark, 60), file_store(str(tmp_path), "kind41"), "new", batch_size=7)
    assert stored(tmp_path, record_id("new"))["state"] == "aborted"
    assert stored(tmp_path, record_id("old"))["state"] == "committed"
    publish(kinds(spark, 60), file_store(str(tmp_path)), "new", batch_size=7)
    record = stored(tmp_path, record_id("new"))
    assert (record["state"], record["items"]) == ("committed", {"kind": 60, "sort": 2})


def test_no_items_are_recorded_too(spark, tmp_path):
    publish(kinds(spark, 0).filter("source_table = 'kind'"), file_store(str(tmp_path)), "none")
    record = stored(tmp_path, record_id("none"))
    assert (record["state"], record["items"]) == ("committed", {})
