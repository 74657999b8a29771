"""Balance fact: one row per sub-account and day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import money, prefixed_key
from daybook.operators.balances import daily_intervals, days_in_order, expand_days, posted
from daybook.plans.dimensions import DEPOSITS, LOANS, Ledger, Run, Tables, placed_accounts
from daybook.plans.targets import TARGETS, conform

INTERVAL = ("first_day", "value_day", "last_day", "balance", "carried")


@dataclass(frozen=True)
class Span:
    """First and last day of a series."""

    start: date
    end: date


def ledger_txns(tables: Tables, ledger: Ledger) -> DataFrame:
    """Posted transactions of a ledger, with cents-exact balances."""
    txns = posted(tables[ledger.txns])
    return txns.withColumns({"date": F.to_date("date"), "balance": money("balance")})


def unparsed_balances(tables: Tables, ledger: Ledger) -> DataFrame:
    """Posted transactions whose balance is there but is no amount; the day before's balance stands in for them."""
    lost = F.col("balance").isNotNull() & money("balance").isNull()
    return posted(tables[ledger.txns]).filter(lost).select(
        F.lit(ledger.txns).alias("ledger"),
        F.col(ledger.txn_holder).cast("string").alias("holder"),
        F.to_date("date").alias("date"),
        F.col("balance").cast("string").alias("balance"),
    )


def ledger_span(tables: Tables, ledger: Ledger, start: date) -> Span:
    """From ``start`` to the last day that any transaction of the ledger has; one day where there is none later."""
    last = tables[ledger.txns].agg(F.max(F.to_date("date")).alias("day")).first().day
    return Span(start, max(start, last or start))


def placed_intervals(tables: Tables, ledger: Ledger, txns: DataFrame, span: Span, carry_in: bool = False) -> DataFrame:
    """Balance intervals with the holder's account and institution, as ``holder, account_id, institution_id`` of the source.

    Holders find their account before they meet the intervals, which arrive partitioned and sorted by
    holder: only the holders move, and days are spelled out after the last join. The transactions are counted first, as the
    partitions follow their number.
    """
    holders = tables[ledger.holders].select(F.col("id").alias("__holder"), "account_id")
    placed = holders.join(placed_accounts(tables), "account_id", "left")
    rows = tables[ledger.txns].count()
    intervals = daily_intervals(txns, ledger.txn_holder, span.start, span.end, carry_in=carry_in, rows=rows)
    return intervals.join(placed, F.col(ledger.txn_holder) == F.col("__holder"), "left").select(
        F.col(ledger.txn_holder).alias("holder"), "account_id", "institution_id", *INTERVAL
    )


def named_intervals(placed: DataFrame, ledger: Ledger) -> DataFrame:
    """Placed intervals under the fact's keys."""
    return placed.select(
        prefixed_key(ledger.prefix, "holder").alias("subaccount_id"),
        prefixed_key("INT", "account_id").alias("account_id"),
        F.col("institution_id").cast("string").alias("company_id"),
        *INTERVAL,
    )


def fact_rows(intervals: DataFrame, run: Run) -> DataFrame:
    """Fact rows of named intervals, in the order of the intervals."""
    return _fact_days(expand_days(intervals), run)


def _fact_days(days: DataFrame, run: Run) -> DataFrame:
    rows = days.select(
        "subaccount_id",
        "account_id",
        F.lit(run.client_id).alias("client_id"),
        "company_id",
        "date",
        F.col("balance").alias("current_balance"),
    )
    return conform(rows, TARGETS["fact_balance_subaccount"], run.run_ts)


def ledger_intervals(tables: Tables, ledger: Ledger, span: Span, carry_in: bool = False) -> DataFrame:
    """A ledger's placed intervals."""
    return placed_intervals(tables, ledger, ledger_txns(tables, ledger), span, carry_in)


def fact_intervals(tables: Tables, ledger: Ledger, span: Span, carry_in: bool = False) -> DataFrame:
    """The fact of one ledger as intervals."""
    return named_intervals(ledger_intervals(tables, ledger, span, carry_in), ledger)


def build_balance_of(tables: Tables, run: Run, ledger: Ledger, span: Span, carry_in: bool = False) -> DataFrame:
    """Daily balances of one ledger; with ``carry_in`` a series opens with the balance of the day before it."""
    return fact_rows(fact_intervals(tables, ledger, span, carry_in), run)


def build_balance(tables: Tables, run: Run, loans: Span, deposits: Span, carry_in: bool = False) -> DataFrame:
    """Daily balances of loans and deposits."""
    return build_balance_of(tables, run, LOANS, loans, carry_in).unionByName(
        build_balance_of(tables, run, DEPOSITS, deposits, carry_in)
    )


def build_ordered_balance(tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    """Daily balances by sub-account and day, in global order.

    The range shuffle moves intervals, one row per transaction day instead of one per day.
    """
    intervals = fact_intervals(tables, LOANS, loans).unionByName(fact_intervals(tables, DEPOSITS, deposits))
    return _fact_days(days_in_order(intervals, "subaccount_id"), run)


def empty_transactions(spark: SparkSession) -> DataFrame:
    """The transactions fact: declared, and empty until a source exists for it."""
    return spark.createDataFrame([], TARGETS["fact_transactions"].schema)
