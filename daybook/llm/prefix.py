"""Running sums in a global order, without a single task that sorts a whole group.

Rows are dealt into ranges of their order that hold few rows each; a running sum within a range is a window, and
the sums of the ranges before it are added by a join. Ranges are numbered 0, 1, ... per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that one window over range totals holds; its totals are summed once more above.
FAN = 1024


def before(order: list[Column], by: list[str], value: str) -> Column:
    """Sum of ``value`` over the rows before this one."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0))


def running(rows: DataFrame, group: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``rows``, which have the columns of ``group`` and ``range``, with the sum of ``value`` before each as ``out``.

    ``range`` must follow ``order``. A window holds one range, FAN range totals, or one total per FAN ranges.
    """
    totals = rows.groupBy(*group, "range").agg(F.sum(value).alias("__sum"))
    totals = totals.withColumn("__upper", F.floor(F.col("range") / FAN))
    upper = totals.groupBy(*group, "__upper").agg(F.sum("__sum").alias("__sum"))
    upper = upper.withColumn("__above", before([F.col("__upper")], group or [F.lit(0)], "__sum")).drop("__sum")
    starts = totals.withColumn("__start", before([F.col("range")], [*group, "__upper"], "__sum"))
    starts = starts.join(upper, [*group, "__upper"]).select(
        *group, "range", (F.col("__start") + F.col("__above")).alias("__start")
    )
    inside = rows.withColumn("__inside", before(order, [*group, "range"], value))
    return inside.join(starts, [*group, "range"]).withColumn(out, F.col("__start") + F.col("__inside")).drop(
        "__start", "__inside"
    )
