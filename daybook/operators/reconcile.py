"""Comparison of two versions of a dataset."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.steps import changes, days_in, steps_of

#: First column of each hash of a value.
SEEDS = (1, 2)


def reconcile(actual: DataFrame, expected: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Differences as rows ``metric, column_name, n``.

    ``missing``: keys only in expected. ``unexpected``: keys only in actual. ``duplicate``: keys
    with several rows on one side; their values are not compared. ``compared``: keys with one
    row on each side. ``mismatch``: of these, the keys whose values differ, per column; null
    equals null.

    Both sides are stacked and grouped by key rather than joined: null keys meet each other, and
    a key repeated on both sides costs its rows, not their product. Values go into the groups as two
    hashes of 64 bits that cancel out where they are equal, so no text is sorted or shuffled; that two
    different values are taken for equal has a chance of about 2 ** -128.
    """
    stacked = _side(actual, keys, columns, 1, 0).unionByName(_side(expected, keys, columns, 0, 1))
    per_key = stacked.groupBy(*(f"__key_{k}" for k in keys)).agg(
        F.sum("__a").alias("a"),
        F.sum("__e").alias("e"),
        *(F.bit_xor(F.xxhash64(F.lit(seed), f"__value_{c}")).alias(f"{seed}_{c}") for seed in SEEDS for c in columns),
    )
    one_each = (F.col("a") == 1) & (F.col("e") == 1)
    counts = per_key.agg(
        F.count_if(F.col("a") == 0).alias("missing"),
        F.count_if(F.col("e") == 0).alias("unexpected"),
        F.count_if((F.col("a") > 1) | (F.col("e") > 1)).alias("duplicate"),
        F.count_if(one_each).alias("compared"),
        *(F.count_if(one_each & _differ(c)).alias(f"mismatch:{c}") for c in columns),
    )
    return _long(counts)


def reconcile_steps(
    actual: DataFrame, expected: DataFrame, keys: Sequence[str], column: str, label: str, rows: int = 0
) -> DataFrame:
    """The same rows for two step functions, counted in days: each side has ``keys, first_day, last_day`` and ``column``.

    Both sides' borders are merged: between two of them either side is constant, so a stretch of days is compared at
    once, and no day is spelled out. ``column`` is a number without nulls, exact in addition, and goes by ``label``.
    ``rows`` is about how many borders there are, as far as that is known.
    """
    zero, one = F.lit(0), F.lit(1)
    sides = (
        actual.select(*keys, "first_day", "last_day", F.col(column).alias("a"), zero.alias("e"), one.alias("as"), zero.alias("es")),
        expected.select(*keys, "first_day", "last_day", zero.alias("a"), F.col(column).alias("e"), zero.alias("as"), one.alias("es")),
    )
    values = ["a", "e", "as", "es"]
    changed = changes(sides[0].unionByName(sides[1]), keys, values)
    both = steps_of(changed, keys, values, rows=rows).withColumn("days", days_in())
    one_each = (F.col("as") == 1) & (F.col("es") == 1)

    def days(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("days"))), F.lit(0))

    counts = both.agg(
        days((F.col("as") == 0) & (F.col("es") > 0)).alias("missing"),
        days((F.col("es") == 0) & (F.col("as") > 0)).alias("unexpected"),
        days((F.col("as") > 1) | (F.col("es") > 1)).alias("duplicate"),
        days(one_each).alias("compared"),
        days(one_each & (F.col("a") != F.col("e"))).alias(f"mismatch:{label}"),
    )
    return _long(counts)


def _long(counts: DataFrame) -> DataFrame:
    part = F.split("__measure", ":", 2)
    return counts.unpivot([], counts.columns, "__measure", "n").select(
        part[0].alias("metric"), F.get(part, F.lit(1)).alias("column_name"), "n"
    )


def _differ(column: str) -> Column:
    return reduce(Column.__or__, (F.col(f"{seed}_{column}") != 0 for seed in SEEDS))


def _side(df: DataFrame, keys: Sequence[str], columns: Sequence[str], a: int, e: int) -> DataFrame:
    return df.select(
        *(F.col(k).alias(f"__key_{k}") for k in keys),
        F.lit(a).alias("__a"),
        F.lit(e).alias("__e"),
        *(F.col(c).alias(f"__value_{c}") for c in columns),
    )
