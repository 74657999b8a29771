"""Dimension tables of the star schema, and the member-account bridge.

Lookups are written as plain left joins: Catalyst broadcasts those whose statistics allow it,
and adaptive execution splits a hot key on the left side of the others.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import lifecycle_status, money, prefixed_key
from daybook.plans.targets import TARGETS, conform
from daybook.sources.series import calendar

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Run:
    """What one build is made for: every table gets the same client and upload time."""

    client_id: int
    run_ts: datetime
    client_name: str = "client"


@dataclass(frozen=True)
class Ledger:
    """One kind of sub-account: where its holders, amounts and transactions are."""

    prefix: str
    holders: str
    amount: str
    side: str
    txns: str
    txn_holder: str


LOANS = Ledger("LOAN", "loan", "current_balance", "liability", "loan_txn", "loan_id")
DEPOSITS = Ledger("SUB", "subaccount", "amount", "asset", "subaccount_txn", "subaccount_id")


def build_client(spark: SparkSession, run: Run) -> DataFrame:
    """The seed row; name and upload time only."""
    row = spark.createDataFrame([(run.client_id, run.client_name)], "client_id int, name string")
    return conform(row, TARGETS["dim_client"], run.run_ts)


def build_calendar(spark: SparkSession, as_of: date, years: int = 2) -> DataFrame:
    """Days around a fixed day; :func:`daybook.sources.series.calendar` takes it from data."""
    anchor = spark.range(1).select(F.lit(as_of).alias("as_of"))
    return conform(calendar(anchor, years), TARGETS["dim_calendar"])


def named_institutions(tables: Tables) -> DataFrame:
    """``institution_id, parent_company_id, company_name``; one row per institution."""
    companies = tables["company"].select(F.col("id").alias("parent_company_id"), F.col("name").alias("company_name"))
    institutions = tables["institution"].select(
        F.col("id").alias("institution_id"), F.col("company_id").alias("parent_company_id")
    )
    return institutions.join(companies, "parent_company_id", "left")


def build_company(tables: Tables, run: Run) -> DataFrame:
    rows = named_institutions(tables).select(
        F.col("institution_id").cast("string").alias("company_id"),
        F.lit(run.client_id).alias("client_id"),
        F.col("company_name").alias("name"),
        F.col("parent_company_id").cast("string").alias("parent_company_id"),
    )
    return conform(rows, TARGETS["dim_company"], run.run_ts)


def role_members(tables: Tables, role_type: str = "MEMBER") -> DataFrame:
    """Members whose sub-role leads to a role of the given type, with the source's columns.

    The filter drops every member without such a role, so the lookups are inner joins.
    """
    roles = tables["role"].filter(F.col("type") == role_type).select(F.col("id").alias("role_id"))
    sub_roles = tables["sub_role"].select(F.col("id").alias("sub_role_id"), "role_id").join(roles, "role_id")
    return tables["member"].join(sub_roles, "sub_role_id").drop("role_id")


def build_member(tables: Tables, run: Run) -> DataFrame:
    rows = role_members(tables).select(
        F.col("id").cast("string").alias("member_id"),
        F.lit(run.client_id).alias("client_id"),
        F.col("institution_id").cast("string").alias("company_id"),
        lifecycle_status("deleted_at").alias("status"),
        F.col("created_at").try_cast("timestamp_ntz").alias("created_at"),
        F.col("deleted_at").try_cast("timestamp_ntz").alias("deleted_at"),
    )
    return conform(rows, TARGETS["dim_member"], run.run_ts)


def build_account(tables: Tables, run: Run) -> DataFrame:
    rows = tables["account"].select(
        prefixed_key("INT", "id").alias("account_id"),
        F.col("institution_id").cast("string").alias("company_id"),
        F.lit(run.client_id).alias("client_id"),
        F.lit("Internal").alias("internal_external"),
    )
    return conform(rows, TARGETS["dim_account"], run.run_ts)


def owned_accounts(tables: Tables, ownership: str = "MEMBER") -> DataFrame:
    """Member-account links of the given ownership, as ``ownership_type`` plus the link's columns."""
    kinds = tables["ownership_type"].filter(F.col("type") == ownership)
    kinds = kinds.select(F.col("id").alias("ownership_type_id"), F.col("key").alias("ownership_type"))
    return tables["member_account"].join(kinds, "ownership_type_id")


def _bridge_rows(links: DataFrame, members: DataFrame, how: str, run: Run) -> DataFrame:
    companies = members.select(F.col("id").alias("member_id"), "institution_id")
    rows = links.join(companies, "member_id", how).select(
        F.col("id").cast("string").alias("member_account_id"),
        F.lit(run.client_id).alias("client_id"),
        F.col("institution_id").cast("string").alias("company_id"),
        F.col("member_id").cast("string").alias("member_id"),
        prefixed_key("INT", "account_id").alias("account_id"),
        "ownership_type",
        F.col("is_primary").cast("boolean").alias("is_primary"),
        lifecycle_status("deleted_at").alias("status"),
        F.col("created_at").try_cast("timestamp_ntz").alias("created_at"),
        F.col("deleted_at").try_cast("timestamp_ntz").alias("deleted_at"),
    )
    return conform(rows, TARGETS["bridge_member_account"], run.run_ts)


def bridge_all_members(tables: Tables, run: Run) -> DataFrame:
    """Bridge rows of every member, whatever the role, and of links without a member row."""
    return _bridge_rows(owned_accounts(tables), tables["member"], "left", run)


def keep_known_members(bridge: DataFrame, members: DataFrame) -> DataFrame:
    """Bridge rows whose member, client and company are in the member dimension."""
    return bridge.join(members, ["member_id", "client_id", "company_id"], "left_semi").select(*bridge.columns)


def build_bridge(tables: Tables, run: Run) -> DataFrame:
    """Bridge rows of members in the member dimension.

    The same rows as :func:`keep_known_members` over :func:`bridge_all_members`. As member ids are
    unique, one join to the role-filtered members both finds the company and drops the others, so
    the links are shuffled once rather than twice. A member without company belongs to none.
    """
    members = role_members(tables).filter(F.col("institution_id").isNotNull())
    return _bridge_rows(owned_accounts(tables), members, "inner", run)


def placed_accounts(tables: Tables) -> DataFrame:
    """``account_id, institution_id`` of each account."""
    return tables["account"].select(F.col("id").alias("account_id"), "institution_id")


def ledger_rows(tables: Tables, ledger: Ledger) -> DataFrame:
    """Holders of one ledger with their type, institution and company name."""
    kinds = tables["account_type"].select(
        F.col("id").alias("account_type_id"), F.col("value").alias("default_type")
    )
    institutions = named_institutions(tables).select("institution_id", "company_name")
    return (
        tables[ledger.holders]
        .join(kinds, "account_type_id", "left")
        .join(placed_accounts(tables), "account_id", "left")
        .join(institutions, "institution_id", "left")
    )


def build_subaccount_of(tables: Tables, run: Run, ledger: Ledger) -> DataFrame:
    rows = ledger_rows(tables, ledger).select(
        prefixed_key(ledger.prefix, "id").alias("subaccount_id"),
        prefixed_key("INT", "account_id").alias("account_id"),
        F.lit(run.client_id).alias("client_id"),
        F.col("institution_id").cast("string").alias("company_id"),
        "company_name",
        F.lit("Internal").alias("internal_or_external"),
        "default_type",
        F.lit("").alias("custom_type"),
        F.lit(ledger.side).alias("default_asset_liability"),
        F.lit("").alias("custom_asset_liability"),
        lifecycle_status("deleted_at").alias("status"),
        money(ledger.amount).alias("current_balance"),
        F.col("created_at").try_cast("timestamp_ntz").alias("created_at"),
        F.col("deleted_at").try_cast("timestamp_ntz").alias("deleted_at"),
    )
    return conform(rows, TARGETS["dim_subaccount"], run.run_ts)


def build_subaccount(tables: Tables, run: Run) -> DataFrame:
    return build_subaccount_of(tables, run, LOANS).unionByName(build_subaccount_of(tables, run, DEPOSITS))
