"""The whole star schema, and the audit of its constraints."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import constraints as check
from daybook.operators.steps import days_in
from daybook.plans import dimensions as dims
from daybook.plans import facts
from daybook.plans.dimensions import Run, Tables
from daybook.plans.facts import Span
from daybook.plans.targets import TARGETS, Target


def build_warehouse(spark: SparkSession, tables: Tables, run: Run, loans: Span, deposits: Span) -> dict[str, DataFrame]:
    """Every target table as a lazy DataFrame, in load order. The calendar is centred on the run's day."""
    return {
        "dim_client": dims.build_client(spark, run),
        "dim_calendar": dims.build_calendar(spark, run.run_ts.date()),
        "dim_company": dims.build_company(tables, run),
        "dim_member": dims.build_member(tables, run),
        "dim_account": dims.build_account(tables, run),
        "dim_subaccount": dims.build_subaccount(tables, run),
        "bridge_member_account": dims.build_bridge(tables, run),
        "fact_balance_subaccount": facts.build_balance(tables, run, loans, deposits),
        "fact_transactions": facts.empty_transactions(spark),
    }


def violations(name: str, built: Mapping[str, DataFrame]) -> DataFrame:
    """Constraint audit of one table: rows ``target, kind, columns, broken``, over all its rows.

    ``broken`` counts rows for nulls and missing parents, and keys for the others.
    """
    target = TARGETS[name]
    df = built[name]
    reports = [
        _nulls(df, target),
        _report(check.check_primary_key(df, target.key), target.key, "primary_key", F.lit(1)),
    ]
    if target.unique:
        reports.append(_report(check.check_unique(df, target.unique), target.unique, "unique", F.lit(1)))
    for ref in target.references:
        orphans = check.check_foreign_key(df, ref.columns, built[ref.parent], ref.parent_columns)
        reports.append(_report(orphans, ref.columns, f"foreign_key:{ref.parent}", F.col("rows")))
    stacked = reduce(DataFrame.unionByName, reports)
    return stacked.select(F.lit(name).alias("target"), "kind", "columns", "broken")


def interval_violations(name: str, intervals: DataFrame, built: Mapping[str, DataFrame], day: str = "date") -> DataFrame:
    """The same audit of a table that is given as intervals, counted in the days they stand for, without spelling them out.

    ``intervals`` has the columns of the table's key and references but for ``day``, and ``first_day, last_day``.
    """
    target = TARGETS[name]
    key = [c for c in target.key if c != day]
    days = days_in()
    nulls = check.check_not_null(intervals.withColumn(day, F.col("first_day")), target.not_null, days)
    repeated = check.check_interval_key(intervals, key)
    reports = [
        nulls.select(F.lit("not_null").alias("kind"), F.col("column_name").alias("columns"), F.col("nulls").alias("broken")),
        _report(repeated, target.key, "primary_key", days),
    ]
    for ref in target.references:
        orphans = check.check_foreign_key(intervals, ref.columns, built[ref.parent], ref.parent_columns, days)
        reports.append(_report(orphans, ref.columns, f"foreign_key:{ref.parent}", F.col("rows")))
    stacked = reduce(DataFrame.unionByName, reports)
    return stacked.select(F.lit(name).alias("target"), "kind", "columns", "broken")


def audit_constraints(built: Mapping[str, DataFrame], intervals: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Constraint audit of all built tables; those in ``intervals`` are audited in that form.

    Every constraint reads its table and its parents: give tables as written, not as plans that each would run again.
    """
    by_interval = intervals or {}
    reports = []
    for name in TARGETS:
        if name in by_interval:
            reports.append(interval_violations(name, by_interval[name], built))
        elif name in built:
            reports.append(violations(name, built))
    return reduce(DataFrame.unionByName, reports)


def _nulls(df: DataFrame, target: Target) -> DataFrame:
    counted = check.check_not_null(df, target.not_null)
    return counted.select(
        F.lit("not_null").alias("kind"), F.col("column_name").alias("columns"), F.col("nulls").alias("broken")
    )


def _report(broken: DataFrame, columns: tuple[str, ...], kind: str, weight: Column) -> DataFrame:
    return broken.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("broken")).select(
        F.lit(kind).alias("kind"), F.lit(",".join(columns)).alias("columns"), "broken"
    )
