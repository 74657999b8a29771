"""Date series generated inside the plan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def days_between(first: Column, last: Column) -> Column:
    """Array of all days from first to last, both included."""
    return F.sequence(first, last, F.expr("interval 1 day"))


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to end."""
    return spark.range(1).select(F.explode(days_between(F.lit(start), F.lit(end))).alias("date"))


def observed_spine(df: DataFrame, day: str) -> DataFrame:
    """One row per day from the first to the last day the data holds."""
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(F.explode(days_between(F.col("first"), F.col("last"))).alias("date"))


def calendar(anchors: DataFrame, years: int = 2) -> DataFrame:
    """Calendar rows from ``years`` before to ``years`` after the latest ``as_of`` day in ``anchors``.

    29 February clamps to 28 February in common years.
    """
    as_of = F.col("as_of")
    days = (
        anchors.agg(F.max("as_of").alias("as_of"))
        .select(
            F.explode(
                days_between(F.add_months(as_of, -12 * years), F.add_months(as_of, 12 * years))
            ).alias("full_date")
        )
    )
    day = F.col("full_date")
    return days.select(
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int").alias("id"),
        day,
        F.dayofmonth(day).cast("smallint").alias("day"),
        F.month(day).cast("smallint").alias("month"),
        F.year(day).cast("smallint").alias("year"),
    )
