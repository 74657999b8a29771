"""Relational constraints as queries for the rows that break them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.steps import COVER, changes, steps_of


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values held by more than one row, with their number. Null counts as different from null."""
    return _counted(df.dropna(subset=list(columns)), columns).filter(F.col("rows") > 1)


def check_primary_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a null, with their number of rows."""
    has_null = F.lit(False)
    for c in columns:
        has_null = has_null | F.col(c).isNull()
    return _counted(df, columns).filter((F.col("rows") > 1) | has_null)


def check_not_null(df: DataFrame, columns: Sequence[str], weight: Column | None = None) -> DataFrame:
    """Nulls per column, as rows ``column_name, nulls``; one pass for all columns. A row counts ``weight`` times."""
    times = F.lit(1).cast("long") if weight is None else weight
    counts = df.agg(*(F.coalesce(F.sum(F.when(F.col(c).isNull(), times)), F.lit(0)).alias(c) for c in columns))
    return counts.unpivot([], list(columns), "column_name", "nulls")


def check_foreign_key(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str], weight: Column | None = None
) -> DataFrame:
    """Child keys without parent, with their number of rows, or sum of weights. A key with a null part passes.

    Keys of both sides are stacked and grouped instead of joined: a parent that most child rows point
    to is combined before the shuffle, and neither side's size matters.
    """
    times = F.lit(1).cast("long") if weight is None else weight
    keys = child.dropna(subset=list(columns)).select(*columns, times.alias("__child"))
    parents = parent.select(
        *(F.col(p).alias(c) for c, p in zip(columns, parent_columns, strict=True)), F.lit(1).alias("__parent")
    )
    met = (
        keys.unionByName(parents, allowMissingColumns=True)
        .groupBy(*columns)
        .agg(F.sum("__child").alias("rows"), F.count("__parent").alias("__parents"))
    )
    return met.filter((F.col("rows") > 0) & (F.col("__parents") == 0)).drop("__parents")


def check_interval_key(intervals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Days on which a key of ``columns`` and day repeats or holds a null: ``columns, first_day, last_day, cover``.

    ``intervals`` has rows ``first_day, last_day``, which stand for their days. A sweep over the borders of a key's
    intervals tells how many hold at a time; no day is spelled out.
    """
    held = steps_of(changes(intervals.select(*columns, "first_day", "last_day"), columns, []), columns, [])
    has_null = reduce(Column.__or__, (F.col(c).isNull() for c in columns))
    return held.filter((F.col(COVER) > 1) | ((F.col(COVER) > 0) & has_null))


def missing_columns(required: Sequence[str]) -> Column:
    """Names of the required columns a row leaves empty, comma-separated; empty text if it fills all."""
    return F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(c)) for c in required))


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that fill all required columns, and the others with the names of their empty ones."""
    rejected = df.withColumn("missing", missing_columns(required)).filter(F.col("missing") != "")
    return df.dropna(subset=list(required)), rejected


def _counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
