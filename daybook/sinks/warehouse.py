"""Build, check and publish the warehouse as one versioned set of Parquet tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.balances import in_range_order, split_months
from daybook.operators.constraints import missing_columns
from daybook.plans import dimensions as dims
from daybook.plans import facts, summaries
from daybook.plans.dimensions import DEPOSITS, LOANS, Run, Tables
from daybook.plans.facts import Span
from daybook.plans.targets import SUMMARIES, TARGETS, Target
from daybook.plans.warehouse import audit_constraints
from daybook.sinks.versions import attempt_path, commit_version, current_path, new_attempt, refuse_committed
from daybook.sources import SOURCE_SCHEMAS, TableSet

FACT = "fact_balance_subaccount"
UNPARSED = "unparsed_balances"
INTERVALS = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("subaccount_id", "account_id", "company_id")]
    + [T.StructField(name, T.DateType()) for name in ("first_day", "value_day", "last_day")]
    + [T.StructField(name, T.DecimalType(18, 2)) for name in ("balance", "carried")]
)


class BrokenConstraints(Exception):
    """The staged tables break their constraints; nothing was published."""


def load_warehouse(
    spark: SparkSession,
    tables: Tables,
    run: Run,
    loans: Span,
    deposits: Span,
    root: str,
    version: str,
    schemas: Mapping[str, str] | None = SOURCE_SCHEMAS,
) -> None:
    """Stage all tables, audit them as written, and publish them together under a label not used before.

    Each call stages in a folder of its own, so one that fails leaves readers where they are and may be repeated.
    Source tables that do not fit their declared ``schemas`` are refused; None takes them as they are.
    Rows that leave a required column empty are staged apart and not published; so are transactions whose balance is
    no amount, as the fact shows the balance before them. The fact's
    intervals are staged before they are spelled out, so neither the audit, which never sees a day, nor the expansion, nor
    the balances of accounts and members run the transactions again, and a lost executor costs no more than the running step.
    """
    refuse_committed(spark, root, version)
    if schemas is not None:
        tables = TableSet(tables.__getitem__, lambda: sorted(tables)).checked(schemas)
    attempt = new_attempt(version)
    staging = attempt_path(root, attempt)
    built = {
        "dim_client": dims.build_client(spark, run),
        "dim_calendar": dims.build_calendar(spark, run.run_ts.date()),
        "dim_company": dims.build_company(tables, run),
        "dim_member": dims.build_member(tables, run),
        "dim_account": dims.build_account(tables, run),
        "dim_subaccount": dims.build_subaccount(tables, run),
        "bridge_member_account": dims.build_bridge(tables, run),
        "fact_transactions": facts.empty_transactions(spark),
    }
    for name, df in built.items():
        _stage(df, TARGETS[name].not_null, f"{staging}/{name}")
    intervals = facts.fact_intervals(tables, LOANS, loans).unionByName(
        facts.fact_intervals(tables, DEPOSITS, deposits)
    )
    typed = intervals.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in INTERVALS))
    _stage(typed, ("subaccount_id", "account_id", "company_id"), f"{staging}/intervals")
    unparsed = facts.unparsed_balances(tables, LOANS).unionByName(facts.unparsed_balances(tables, DEPOSITS))
    unparsed.write.parquet(f"{staging}/{UNPARSED}")
    _write_fact(spark, run, staging)
    _write_summaries(spark, run, staging)

    staged = {name: read_staged(spark, staging, name) for name in TARGETS if name != FACT}
    keyed = read_intervals(spark, staging).withColumn("client_id", F.lit(run.client_id))
    broken = audit_constraints(staged, {FACT: keyed}).filter(F.col("broken") > 0)
    findings = [" ".join(map(str, row)) for row in broken.collect()]  # at most one row per declared constraint
    if findings:
        raise BrokenConstraints("; ".join(findings))
    commit_version(spark, root, version, attempt)


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published tables."""
    published = current_path(spark, root)
    return {name: read_staged(spark, published, name) for name in TARGETS}


def read_summaries(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The published daily balances of accounts and members."""
    published = current_path(spark, root)
    return {name: _read_months(spark, target, f"{published}/{name}") for name, target in SUMMARIES.items()}


def read_staged(spark: SparkSession, staging: str, name: str) -> DataFrame:
    """The rows of a staged table that are, or would be, published."""
    target = TARGETS[name]
    if name == FACT:
        return _read_months(spark, target, f"{staging}/{name}")
    return _read_state(spark, target.schema, f"{staging}/{name}", "accepted").drop("missing")


def _read_months(spark: SparkSession, target: Target, path: str) -> DataFrame:
    laid_out = T.StructType([*target.schema, T.StructField("month", T.DateType())])
    return spark.read.schema(laid_out).parquet(path).drop("month")


def read_rejects(spark: SparkSession, staging: str, name: str) -> DataFrame:
    """Rows of a staged dimension or bridge left out of it, with the names of their empty columns."""
    return _read_state(spark, TARGETS[name].schema, f"{staging}/{name}", "rejected")


def read_rejected_intervals(spark: SparkSession, staging: str) -> DataFrame:
    """Balance intervals left out of the fact, with the names of their empty columns."""
    return _read_state(spark, INTERVALS, f"{staging}/intervals", "rejected")


def read_intervals(spark: SparkSession, staging: str) -> DataFrame:
    """The balance intervals that the fact spells out."""
    return _read_state(spark, INTERVALS, f"{staging}/intervals", "accepted")


def read_unparsed_balances(spark: SparkSession, staging: str) -> DataFrame:
    """Posted transactions left out of the series as their balance is no amount."""
    return spark.read.schema("ledger string, holder string, date date, balance string").parquet(f"{staging}/{UNPARSED}")


def _stage(df: DataFrame, required: tuple[str, ...], path: str) -> None:
    """One pass writes accepted and rejected rows, into a partition each."""
    marked = df.withColumn("missing", missing_columns(required))
    marked = marked.withColumn("state", F.when(F.col("missing") == "", "accepted").otherwise("rejected"))
    marked.write.mode("errorifexists").option("compression", "zstd").partitionBy("state").parquet(path)


def _read_state(spark: SparkSession, schema: T.StructType, path: str, state: str) -> DataFrame:
    # An explicit schema, as a table without rows leaves no file to take it from.
    text = [T.StructField(name, T.StringType()) for name in ("missing", "state")]
    return spark.read.schema(T.StructType([*schema, *text])).parquet(path).filter(F.col("state") == state).drop("state")


def _write_fact(spark: SparkSession, run: Run, staging: str) -> None:
    """Spell the staged intervals out into a fact partitioned by month and sorted by sub-account.

    The range shuffle moves intervals cut at month ends, so each task writes few months
    and each month few files.
    """
    accepted = read_intervals(spark, staging)
    laid_out = in_range_order(split_months(accepted), "month", "subaccount_id", "first_day")
    _write_months(facts.fact_rows(laid_out, run), f"{staging}/{FACT}")


def _write_summaries(spark: SparkSession, run: Run, staging: str) -> None:
    """Account and member balances, laid out like the fact, from its staged intervals and the staged bridge."""
    accepted = read_intervals(spark, staging)
    bridge = read_staged(spark, staging, "bridge_member_account")
    for name, target in SUMMARIES.items():
        intervals = summaries.summary_intervals(name, accepted, bridge)
        laid_out = in_range_order(split_months(intervals), "month", target.key[0], "first_day").drop("month")
        _write_months(summaries.summary_rows(name, laid_out, run), f"{staging}/{name}")


def _write_months(days: DataFrame, path: str) -> None:
    months = days.withColumn("month", F.trunc("date", "month"))
    months.write.mode("errorifexists").option("compression", "zstd").partitionBy("month").parquet(path)
