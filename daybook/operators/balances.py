"""Daily series per entity.

Two shapes of the same result live here:

* *spine and fill*: entities x days, joined to the last value of each day, filled with a
  running window. Every expanded day goes through the shuffles.
* *gap expansion*: the last value of each day becomes an interval up to the entity's next
  one, and the intervals are spelled out into days at the very end. Only days that hold a
  transaction are shuffled. The balance facts use this one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.sources.series import days_between

NEWEST_FIRST = ("created_at", "seq")
#: Rows that one task should sort or group at most; at one to three hundred bytes each they take a part of its memory.
TASK_ROWS = 1_000_000


def posted(txns: DataFrame) -> DataFrame:
    """Transactions that count: neither flagged with a status nor deleted."""
    return txns.filter(F.col("status").isNull() & F.col("deleted_at").isNull())


def active_entities(txns: DataFrame, entity: str) -> DataFrame:
    """Entities with at least one of the given transactions."""
    return txns.select(entity).distinct()


def latest_per_day(
    txns: DataFrame, entity: str, day: str = "date", value: str = "balance", order: Sequence[str] = NEWEST_FIRST
) -> DataFrame:
    """The value of each entity's last transaction of each day.

    Newest by the ``order`` columns, in turn; nulls are oldest. Equal order values fall back
    to the larger value, so the result does not depend on row order. As an aggregate it is
    combined before the shuffle: an entity, or a single day of it, that holds most of the
    rows shrinks to one row per input partition.
    """
    newest = F.max(F.struct(*order, F.col(value).alias("__value")))
    return (
        txns.groupBy(entity, day)
        .agg(newest.alias("__newest"))
        .select(entity, day, F.col("__newest.__value").alias(value))
    )


def entity_spine(entities: DataFrame, start: date, end: date) -> DataFrame:
    """Each entity row on each day from start to end. Generated per row, without a join."""
    return entities.withColumn("date", F.explode(days_between(F.lit(start), F.lit(end))))


def _so_far(entity: str, day: str) -> Window:
    by_day = Window.partitionBy(entity).orderBy(F.col(day).asc_nulls_last())
    return by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def forward_fill(series: DataFrame, entity: str, value: str, day: str = "date", default: object = 0) -> DataFrame:
    """Replace nulls by the entity's latest earlier value, and by ``default`` before its first."""
    filled = F.last(value, ignorenulls=True).over(_so_far(entity, day))
    return series.withColumn(value, F.coalesce(filled, F.lit(default).cast(series.schema[value].dataType)))


def running_max(series: DataFrame, entity: str, value: str, day: str = "date", default: object = 0) -> DataFrame:
    """Replace nulls by the entity's largest earlier value, and by ``default`` before its first."""
    largest = F.max(value).over(_so_far(entity, day))
    return series.withColumn(
        value, F.coalesce(F.col(value), largest, F.lit(default).cast(series.schema[value].dataType))
    )


def carry_last(entity: str) -> Column:
    """Between two transactions, the balance of the earlier one holds."""
    return F.col("balance")


def carry_max(entity: str) -> Column:
    """Between two transactions, the largest balance seen so far holds."""
    return F.max("balance").over(_so_far(entity, "__day"))


def daily_intervals(
    txns: DataFrame,
    entity: str,
    start: date,
    end: date,
    day: str = "date",
    value: str = "balance",
    carry=carry_last,
    carry_in: bool = False,
    rows: int = 0,
) -> DataFrame:
    """The series in sparse form: ``entity, first_day, value_day, last_day, balance, carried``.

    Rows of an entity tile start..end without overlap. On ``value_day`` the balance is
    ``balance``, on later days of the interval ``carried``, on earlier days zero.

    * Days outside start..end, and days whose last transaction has no balance, open no
      interval; the entity still gets its zero series from them.
    * A null entity never equals anything, so it has the zero series only.
    * ``carry_in`` opens the series with what held the day before: earlier days count like days in range, and the
      intervals are cut at the start. A group of the window then holds the entity's earlier days too.

    The first shuffle carries one row per entity, day and input partition, the second one row
    per entity and day, so a group of the window never exceeds the days in range by more than one.
    The second one keeps the session's number of partitions, or more if ``rows``, the number of transactions, asks for them
    (see :func:`partitions_for`): adaptive execution would merge them by their size before the days are spelled out, which
    is a small part of the size after.
    """
    points = daily_points(txns, entity, None if carry_in else start, end, day, value)
    intervals = tiled(points, entity, start, end, carry, rows)
    if not carry_in:
        return intervals
    earlier = F.col("value_day") < F.lit(start)
    return intervals.filter(F.col("last_day") >= F.lit(start)).withColumns(
        {
            "first_day": F.greatest("first_day", F.lit(start)),
            "value_day": F.greatest("value_day", F.lit(start)),
            "balance": F.when(earlier, F.col("carried")).otherwise(F.col("balance")),
        }
    )


def daily_points(
    txns: DataFrame, entity: str, start: date | Column | None, end: date, day: str = "date", value: str = "balance"
) -> DataFrame:
    """``entity, day, balance`` where a new balance begins to hold: the last one of a day from start to end.

    A row without a day stands for what opens no interval: transactions on other days, or without an entity, and days
    whose last transaction has no balance. Every entity has one row at least. ``start`` may be a column of ``txns``.
    """
    in_range = (F.col(day) <= F.lit(end)) & F.col(entity).isNotNull()
    if start is not None:
        in_range = in_range & (F.col(day) >= (start if isinstance(start, Column) else F.lit(start)))
    inside = [F.when(in_range, F.col(c)).alias(c) for c in (*NEWEST_FIRST, value)]
    scoped = txns.select(entity, F.when(in_range, F.col(day)).alias("__date"), *inside)
    last = latest_per_day(scoped, entity, "__date", value)
    return last.select(entity, F.when(F.col(value).isNotNull(), F.col("__date")).alias("day"), F.col(value).alias("balance"))


def tiled(points: DataFrame, entity: str, start: date, end: date, carry=carry_last, rows: int = 0) -> DataFrame:
    """Intervals of :func:`daily_intervals` from points; further columns, alike in all points of an entity, are kept.

    ``rows`` is about how many points there are, as far as that is known.
    """
    rest = [c for c in points.columns if c not in (entity, "day", "balance")]
    spread = points.withColumnRenamed("day", "__day").repartition(partitions_for(points, rows), entity)
    by_day = Window.partitionBy(entity).orderBy(F.col("__day").asc_nulls_last())
    tiles = spread.select(
        entity,
        *rest,
        "__day",
        "balance",
        carry(entity).alias("carried"),
        F.row_number().over(by_day).alias("__nth"),
        F.lead("__day").over(by_day).alias("__next"),
    ).filter(F.col("__day").isNotNull() | (F.col("__nth") == 1))
    return tiles.select(
        entity,
        *rest,
        F.when(F.col("__nth") == 1, F.lit(start)).otherwise(F.col("__day")).alias("first_day"),
        F.coalesce("__day", F.lit(end + timedelta(days=1))).alias("value_day"),
        F.coalesce(F.date_sub("__next", 1), F.lit(end)).alias("last_day"),
        "balance",
        "carried",
    )


def days_in_order(intervals: DataFrame, entity: str) -> DataFrame:
    """Days of the intervals in global order of entity and day, nulls last.

    Intervals move to ranges of the entity alone; days are spelled out there and sorted in place, so an entity whose
    intervals overlap keeps its days in order too, and no day is shuffled.
    """
    order = F.col(entity).asc_nulls_last()
    ranged = intervals.repartitionByRange(shuffle_partitions(intervals), order)
    return expand_days(ranged).sortWithinPartitions(order, F.col("date").asc_nulls_last())


def in_range_order(intervals: DataFrame, *columns: str, rows: int = 0) -> DataFrame:
    """Intervals in global order of the columns, nulls last, ready to be spelled out in place.

    Sorts like ``orderBy``, in the session's number of partitions (see :func:`daily_intervals`), or in those that ``rows``
    asks for, the number of days that will be spelled out.
    """
    order = [F.col(c).asc_nulls_last() for c in columns]
    return intervals.repartitionByRange(partitions_for(intervals, rows), *order).sortWithinPartitions(*order)


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions that days are spelled out in: the session's ``daybook.series.partitions``, else its shuffle partitions.

    Set it to the expected number of days over the rows that a task should write.
    """
    conf = df.sparkSession.conf
    return int(conf.get("daybook.series.partitions", None) or conf.get("spark.sql.shuffle.partitions"))


def partitions_for(df: DataFrame, rows: int) -> int:
    """Partitions for about so many rows: those of :func:`shuffle_partitions`, and enough that none has over ``TASK_ROWS``.

    What a task sorts or groups then stays as large as it is, however the input grows and whatever the session is set to.
    A repartition by this number is not merged by adaptive execution, which goes by compressed bytes: those of days and
    steps are a small part of their size in memory.
    """
    return max(shuffle_partitions(df), math.ceil(rows / TASK_ROWS))


def split_months(intervals: DataFrame) -> DataFrame:
    """Cut intervals at month ends and name the month each piece lies in by its first day.

    Lets a month-partitioned table be laid out by shuffling intervals instead of days.
    """
    months = F.sequence(F.trunc("first_day", "month"), F.col("last_day"), F.expr("interval 1 month"))
    return intervals.withColumn("month", F.explode(months)).withColumns(
        {"first_day": F.greatest("first_day", "month"), "last_day": F.least("last_day", F.last_day("month"))}
    )


def expand_days(intervals: DataFrame) -> DataFrame:
    """Spell intervals out into one row per day, in the order of the input rows."""
    keep = [c for c in intervals.columns if c not in ("first_day", "value_day", "last_day", "balance", "carried")]
    days = intervals.select("*", F.explode(days_between(F.col("first_day"), F.col("last_day"))).alias("date"))
    zero = F.lit(0).cast(intervals.schema["balance"].dataType)
    on_day = (
        F.when(F.col("date") == F.col("value_day"), F.col("balance"))
        .when(F.col("date") > F.col("value_day"), F.col("carried"))
        .otherwise(zero)
    )
    return days.select(*keep, "date", on_day.alias("balance"))


def series_with_gaps(
    txns: DataFrame, entity: str, start: date, end: date, day: str = "date", value: str = "balance"
) -> DataFrame:
    """Entities x days with the last value of each day, null on days without one.

    The rows of :func:`entity_spine` joined to :func:`latest_per_day`, but made from intervals: the days
    arrive partitioned by entity, so neither a join nor a following fill shuffles them.
    """
    intervals = daily_intervals(txns, entity, start, end, day, value)
    days = intervals.select(
        entity, F.explode(days_between(F.col("first_day"), F.col("last_day"))).alias("date"), "value_day", "balance"
    )
    return days.select(entity, "date", F.when(F.col("date") == F.col("value_day"), F.col("balance")).alias(value))


def daily_balance(txns: DataFrame, entity: str, start: date, end: date, carry_in: bool = False, **columns: str) -> DataFrame:
    """One balance per entity and day: the last known one, zero before the first in range, or ever with ``carry_in``."""
    return expand_days(daily_intervals(txns, entity, start, end, carry_in=carry_in, **columns))
