"""Step functions as differences.

A row ``first_day, last_day`` with values says that they hold on those days. Taken as a rise on the first day and a fall
on the day after the last, any number of such rows is added up by summing changes per day and running over the days
that have one: nothing is spelled out into days, and a group never holds more rows than there are days in range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.balances import partitions_for

#: How many of the rows added up hold on a day.
COVER = "cover"


def as_steps(intervals: DataFrame) -> DataFrame:
    """Balance intervals as rows of one balance each: zero before ``value_day``, ``carried`` after it."""
    rest = [c for c in intervals.columns if c not in ("first_day", "value_day", "last_day", "balance", "carried")]
    zero = F.lit(0).cast(intervals.schema["balance"].dataType)
    on_day, after = F.col("value_day"), F.date_add("value_day", 1)
    same = F.col("balance").eqNullSafe(F.col("carried"))

    def piece(first: Column, last: Column, balance: Column) -> Column:
        return F.struct(first.alias("first_day"), last.alias("last_day"), balance.alias("balance"))

    pieces = F.array(
        piece(F.col("first_day"), F.least("last_day", F.date_sub(on_day, 1)), zero),
        piece(on_day, F.when(same, F.col("last_day")).otherwise(F.least("last_day", on_day)), F.col("balance")),
        F.when(~same, piece(after, F.col("last_day"), F.col("carried"))),
    )
    there = F.filter(pieces, lambda p: p["first_day"] <= p["last_day"])
    return intervals.select(*rest, F.explode(there).alias("__piece")).select(*rest, "__piece.*")


def changes(steps: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``by, day``, and by how much each value and the cover change there; one row per group and day."""

    def change(day: Column, sign: int) -> Column:
        return F.struct(day.alias("day"), *((F.col(v) * sign).alias(v) for v in values), F.lit(sign).alias(COVER))

    both = F.array(change(F.col("first_day"), 1), change(F.date_add("last_day", 1), -1))
    rows = steps.select(*by, F.explode(both).alias("__change")).select(*by, "__change.*")
    return add_changes(rows, by, values)


def add_changes(rows: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Changes added up per group and day, combined before the shuffle; days on which they cancel out are left out."""
    measures = [*values, COVER]
    added = rows.groupBy(*by, "day").agg(*(F.sum(m).alias(m) for m in measures))
    return added.filter(reduce(Column.__or__, (F.col(m) != 0 for m in measures)))


def steps_of(
    changed: DataFrame, by: Sequence[str], values: Sequence[str], spelled_out: bool = False, rows: int = 0
) -> DataFrame:
    """``by, first_day, last_day``, values and cover from changes; one row per stretch without a change.

    Stretches that nothing covers are among them, as far as they lie between two changes. ``spelled_out`` keeps the number of
    partitions that days need (see :func:`daybook.operators.balances.shuffle_partitions`), and ``rows``, about the number of
    changes where that is known, those that they need.
    """
    if spelled_out or rows:
        changed = changed.repartition(partitions_for(changed, rows), *by)
    by_day = Window.partitionBy(*by).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = changed.select(
        *by,
        F.col("day").alias("first_day"),
        F.date_sub(F.lead("day").over(by_day), 1).alias("last_day"),
        *(F.sum(m).over(so_far).alias(m) for m in (*values, COVER)),
    )
    return run.filter(F.col("last_day").isNotNull())


def days_in(first: str = "first_day", last: str = "last_day") -> Column:
    """How many days a step holds."""
    return (F.datediff(last, first) + 1).cast("long")
