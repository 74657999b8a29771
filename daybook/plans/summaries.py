"""Daily balances of accounts and of members, added up from sub-account intervals without spelling those out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.balances import expand_days
from daybook.operators.steps import COVER, add_changes, as_steps, changes, steps_of
from daybook.plans import dimensions as dims
from daybook.plans.dimensions import DEPOSITS, LOANS, Run, Tables
from daybook.plans.facts import Span, fact_intervals
from daybook.plans.targets import SUMMARIES, conform

ACCOUNT, MEMBER = "fact_balance_account", "fact_balance_member"
_OF_ACCOUNT, _OF_MEMBER = ["account_id", "company_id"], ["member_id", "company_id"]


def account_changes(intervals: DataFrame) -> DataFrame:
    """By how much each account's balance changes, per day with a change. Holders without an account have none."""
    named = intervals.filter(F.col("account_id").isNotNull())
    steps = as_steps(named.select(*_OF_ACCOUNT, "first_day", "value_day", "last_day", "balance", "carried"))
    return changes(steps, _OF_ACCOUNT, ["balance"])


def member_changes(intervals: DataFrame, bridge: DataFrame) -> DataFrame:
    """The same per member, over the accounts that active links of the bridge name.

    Several links of a member to one account count once. Changes of accounts meet the links, not days.
    """
    links = bridge.filter(F.col("status") == "ACTIVE").select(*_OF_MEMBER, "account_id").dropna(subset=["account_id"]).distinct()
    moved = account_changes(intervals).drop("company_id").join(links, "account_id")
    return add_changes(moved.select(*_OF_MEMBER, "day", "balance", COVER), _OF_MEMBER, ["balance"])


def summary_intervals(name: str, intervals: DataFrame, bridge: DataFrame) -> DataFrame:
    """A summary's balances as intervals: days on which at least one of the added-up series holds."""
    if name == ACCOUNT:
        steps = steps_of(account_changes(intervals), _OF_ACCOUNT, ["balance"], spelled_out=True)
    else:
        steps = steps_of(member_changes(intervals, bridge), _OF_MEMBER, ["balance"], spelled_out=True)
    return steps.filter(F.col(COVER) > 0).drop(COVER).withColumns({"value_day": F.col("first_day"), "carried": F.col("balance")})


def summary_rows(name: str, intervals: DataFrame, run: Run) -> DataFrame:
    """Summary rows of its intervals, in their order."""
    days = expand_days(intervals).withColumnRenamed("balance", "current_balance")
    return conform(days.withColumn("client_id", F.lit(run.client_id)), SUMMARIES[name], run.run_ts)


def build_summary(name: str, tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    intervals = fact_intervals(tables, LOANS, loans).unionByName(fact_intervals(tables, DEPOSITS, deposits))
    return summary_rows(name, summary_intervals(name, intervals, dims.build_bridge(tables, run)), run)


def build_account_balance(tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    """Per account and day, the sum over its loans and deposits, on days that any of them has a balance for."""
    return build_summary(ACCOUNT, tables, run, loans, deposits)


def build_member_balance(tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    """Per member and day, the sum over the accounts that the member is actively linked to."""
    return build_summary(MEMBER, tables, run, loans, deposits)
