"""Fills of series of any length: a prefix scan over segments.

A window over a whole entity holds it in one task. Here rows are dealt into ranges of entity and order, however many rows
an entity has; a window runs within a range, and the ends of the ranges before it are carried over. Only the first
entity of a range can have begun earlier, so there is less than one carried row per range, and that is all that is
broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.balances import shuffle_partitions
from daybook.scratch import kept


def forward_fill_ranges(
    series: DataFrame,
    entity: str,
    value: str,
    order: Sequence[str] = ("date",),
    default: object = 0,
    ranges: int | None = None,
) -> DataFrame:
    """Replace nulls by the entity's latest earlier value, and by ``default`` before its first.

    Nulls in ``order`` are last; rows alike in it go by value, nulls first, so the result does not depend on row order. A
    null entity is a series of its own. The rows are written once, in ``ranges`` parts (see
    :func:`daybook.operators.balances.shuffle_partitions`), when the operator is called.
    """
    ranged = _ranged(series, entity, value, order, ranges)
    place = F.struct(*(f for c in order for f in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))), F.col(value).alias("__value"))
    end = F.max(F.when(F.col(value).isNotNull(), place))["__value"]
    carried = _carried(ranged, entity, end, lambda c: F.last(c, ignorenulls=True))
    inside = F.last(value, ignorenulls=True).over(_inside(entity, value, order))
    return _filled(ranged, carried, entity, value, inside, default, series.columns)


def running_max_ranges(
    series: DataFrame,
    entity: str,
    value: str,
    order: Sequence[str] = ("date",),
    default: object = 0,
    ranges: int | None = None,
) -> DataFrame:
    """Replace nulls by the entity's largest earlier value, and by ``default`` before its first; else as above."""
    ranged = _ranged(series, entity, value, order, ranges)
    carried = _carried(ranged, entity, F.max(value), F.max)
    inside = F.max(value).over(_inside(entity, value, order))
    inside = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(F.greatest(inside, "__carry"))
    return _filled(ranged, carried, entity, value, inside, default, series.columns)


def _sorted(value: str, order: Sequence[str]) -> list[Column]:
    return [*(F.col(c).asc_nulls_last() for c in order), F.col(value).asc_nulls_first()]


def _ranged(series: DataFrame, entity: str, value: str, order: Sequence[str], ranges: int | None) -> DataFrame:
    """The rows with the number of their range, which is written, as borders of ranges are sampled."""
    # Rows alike in all that orders them may lie in several ranges: any order of theirs gives the same fills.
    spread = series.withColumn("__spread", F.rand(0))
    keys = [F.col(entity).asc_nulls_last(), *_sorted(value, order), F.col("__spread")]
    ranged = spread.repartitionByRange(ranges or shuffle_partitions(series), *keys)
    return kept(ranged.drop("__spread").withColumn("__range", F.spark_partition_id()), "ranges")


def _carried(ranged: DataFrame, entity: str, end: Column, over) -> DataFrame:
    """``__range, __entity, __carry`` of each range whose first entity began in an earlier one."""
    ends = ranged.groupBy(F.col(entity).alias("__entity"), "__range").agg(end.alias("__end"))
    by_range = Window.partitionBy("__entity").orderBy("__range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("__entity", "__range", over("__end").over(earlier).alias("__carry"), F.row_number().over(by_range).alias("__nth"))
    return carried.filter("__nth > 1").drop("__nth")


def _inside(entity: str, value: str, order: Sequence[str]) -> Window:
    by_order = Window.partitionBy("__range", entity).orderBy(*_sorted(value, order))
    return by_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _filled(
    ranged: DataFrame, carried: DataFrame, entity: str, value: str, inside: Column, default: object, columns: list[str]
) -> DataFrame:
    named = carried.withColumnRenamed("__range", "__at")
    here = (F.col("__range") == F.col("__at")) & F.col(entity).eqNullSafe(F.col("__entity"))
    joined = ranged.join(F.broadcast(named), here, "left").drop("__at", "__entity")
    zero = F.lit(default).cast(ranged.schema[value].dataType)
    return joined.withColumn(value, F.coalesce(inside, F.col("__carry"), zero)).select(*columns)
