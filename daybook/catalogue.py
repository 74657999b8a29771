"""Named queries over the bank tables of one data folder."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import operators as ops
from daybook import sinks
from daybook.functions import prefixed_key
from daybook.plans import DEPOSITS, LOANS, TARGETS, Run, Span, audit, audit_constraints, build_warehouse, conform
from daybook.plans import dimensions as dims
from daybook.plans import facts, summaries
from daybook.plans.dimensions import Ledger, Tables
from daybook.scratch import kept, new_folder
from daybook.sources import (
    TableSet,
    apply_rules,
    bank_tables,
    calendar,
    observed_spine,
    parse_rules,
)

Query = Callable[[SparkSession, str], DataFrame]

RUN = Run(client_id=1, run_ts=datetime(2024, 2, 1))
# The loans' transactions begin on 1995-01-02, the deposits' on 2024-01-01. Both series start later than that, so that
# opening balances before the start are part of the test. They end on the last day that the ledger has.
LOAN_START, DEPOSIT_START = date(1995, 2, 1), date(2024, 1, 3)

#: Orders the transactions of a whole ledger.
LEDGER_ORDER = ("date", "created_at", "seq")

REPLICATED = (
    "member", "sub_role", "role", "institution", "company", "member_account", "account", "subaccount", "loan",
    "external_subaccount", "external_subaccount_member", "account_type", "ownership_type", "txn_info", "txn_category",
)
TXN_TABLES = ("subaccount_txn", "loan_txn")
DICTIONARIES = ("ownership_type", "account_type", "member_status", "txn_category", "role", "sub_role", "company")


def replication_rules() -> str:
    """The rule document of the bank tables: plain includes, and null filters on the transactions."""

    def rule(table: str, **more) -> dict:
        locator = {"schema-name": "public", "table-name": table}
        return {"rule-type": "selection", "rule-action": "include", "object-locator": locator, **more}

    def null_filter(column: str) -> dict:
        return {"filter-type": "source", "column-name": column, "filter-conditions": [{"filter-operator": "null"}]}

    filters = [null_filter("status"), null_filter("deleted_at")]
    rules = [rule(t) for t in REPLICATED] + [rule(t, filters=filters) for t in TXN_TABLES]
    return json.dumps({"rules": rules})


def loan_span(tables: Tables) -> Span:
    return facts.ledger_span(tables, LOANS, LOAN_START)


def deposit_span(tables: Tables) -> Span:
    return facts.ledger_span(tables, DEPOSITS, DEPOSIT_START)


def spans(tables: Tables) -> tuple[Span, Span]:
    return loan_span(tables), deposit_span(tables)


WILDCARD_RULES = """{"rules": [{"rule-type": "selection", "rule-action": "include",
    "object-locator": {"schema-name": "public", "table-name": "%"}}]}"""

_QUERIES: dict[str, Query] = {}


def over_bank(build: Callable[[Tables], DataFrame]) -> Callable:
    """Register a query that needs the bank tables only."""
    _QUERIES[build.__name__] = lambda spark, folder: build(bank_tables(spark, folder))
    return build


def over_folder(build: Query) -> Query:
    """Register a query that needs the session and the folder."""
    _QUERIES[build.__name__] = build
    return build


def catalogue() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources -------------------------------------------------------------------------------------


@over_folder
def scan_source(spark: SparkSession, folder: str) -> DataFrame:
    return TableSet.from_directory(spark, folder)["orders"]


def _row_counts(selected: dict[str, DataFrame]) -> DataFrame:
    counts = (
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in selected.items()
    )
    return reduce(DataFrame.unionByName, counts)


@over_bank
def ingest_select(tables: Tables) -> DataFrame:
    return _row_counts(apply_rules(tables, parse_rules(replication_rules())))


@over_folder
def ingest_wildcard(spark: SparkSession, folder: str) -> DataFrame:
    return _row_counts(apply_rules(TableSet.from_directory(spark, folder), parse_rules(WILDCARD_RULES)))


@over_bank
def ingest_null_filters(tables: Tables) -> DataFrame:
    selected = apply_rules(tables, parse_rules(replication_rules()))
    kept = [
        selected[ledger.txns].select(
            F.lit(ledger.txns).alias("table_name"), F.col(ledger.txn_holder).alias("holder"), "date", "seq", "balance"
        )
        for ledger in (LOANS, DEPOSITS)
    ]
    return kept[0].unionByName(kept[1])


@over_bank
def date_spine(tables: Tables) -> DataFrame:
    return observed_spine(tables["loan_txn"], "date")


# --- daily series --------------------------------------------------------------------------------


def _loan_txns(tables: Tables) -> DataFrame:
    return facts.ledger_txns(tables, LOANS)


@over_bank
def posted_txns(tables: Tables) -> DataFrame:
    return ops.posted(tables["loan_txn"])


@over_bank
def active_entities(tables: Tables) -> DataFrame:
    return ops.active_entities(ops.posted(tables["loan_txn"]), "loan_id")


@over_bank
def entity_date_spine(tables: Tables) -> DataFrame:
    span = loan_span(tables)
    return ops.entity_spine(active_entities(tables), span.start, span.end)


@over_bank
def last_txn_per_day(tables: Tables) -> DataFrame:
    return ops.latest_per_day(_loan_txns(tables), "loan_id")


@over_bank
def forward_fill_balance(tables: Tables) -> DataFrame:
    span = loan_span(tables)
    series = ops.series_with_gaps(_loan_txns(tables), "loan_id", span.start, span.end)
    return ops.forward_fill(series, "loan_id", "balance")


@over_bank
def running_max_balance(tables: Tables) -> DataFrame:
    span = loan_span(tables)
    series = ops.series_with_gaps(_loan_txns(tables), "loan_id", span.start, span.end)
    return ops.running_max(series, "loan_id", "balance")


def whole_ledgers(tables: Tables) -> DataFrame:
    """Each ledger's posted transactions as one series."""
    ledgers = (
        facts.ledger_txns(tables, ledger).select(
            F.lit(ledger.txns).alias("ledger"), F.col(ledger.txn_holder).alias("holder"), *LEDGER_ORDER, "balance"
        )
        for ledger in (LOANS, DEPOSITS)
    )
    return reduce(DataFrame.unionByName, ledgers)


@over_bank
def ledger_last_known(tables: Tables) -> DataFrame:
    return ops.forward_fill_ranges(whole_ledgers(tables), "ledger", "balance", LEDGER_ORDER)


@over_bank
def ledger_largest(tables: Tables) -> DataFrame:
    return ops.running_max_ranges(whole_ledgers(tables), "ledger", "balance", LEDGER_ORDER)


# --- star schema ---------------------------------------------------------------------------------


@over_bank
def dim_calendar(tables: Tables) -> DataFrame:
    return calendar(tables["subaccount_txn"].select(F.col("date").alias("as_of")))


@over_bank
def dim_company(tables: Tables) -> DataFrame:
    return dims.build_company(tables, RUN)


@over_bank
def dim_member(tables: Tables) -> DataFrame:
    return dims.build_member(tables, RUN)


@over_bank
def dim_account(tables: Tables) -> DataFrame:
    return dims.build_account(tables, RUN)


@over_bank
def bridge_unfiltered(tables: Tables) -> DataFrame:
    return dims.bridge_all_members(tables, RUN)


@over_bank
def bridge_semi_join(tables: Tables) -> DataFrame:
    return dims.keep_known_members(bridge_unfiltered(tables), dim_member(tables))


@over_bank
def bridge_member_account(tables: Tables) -> DataFrame:
    return dims.build_bridge(tables, RUN)


@over_bank
def dim_subaccount_loan(tables: Tables) -> DataFrame:
    return dims.build_subaccount_of(tables, RUN, LOANS)


@over_bank
def dim_subaccount_sub(tables: Tables) -> DataFrame:
    return dims.build_subaccount_of(tables, RUN, DEPOSITS)


@over_bank
def dim_subaccount(tables: Tables) -> DataFrame:
    return dims.build_subaccount(tables, RUN)


@over_bank
def fact_balance_loan(tables: Tables) -> DataFrame:
    return facts.build_balance_of(tables, RUN, LOANS, loan_span(tables))


@over_bank
def fact_balance_sub(tables: Tables) -> DataFrame:
    return facts.build_balance_of(tables, RUN, DEPOSITS, deposit_span(tables))


@over_bank
def fact_balance_subaccount(tables: Tables) -> DataFrame:
    return facts.build_balance(tables, RUN, *spans(tables))


@over_bank
def fact_ordered(tables: Tables) -> DataFrame:
    return facts.build_ordered_balance(tables, RUN, *spans(tables))


@over_bank
def fact_balance_carried(tables: Tables) -> DataFrame:
    """Daily balances that open with what held before the series."""
    return facts.build_balance(tables, RUN, *spans(tables), carry_in=True)


@over_bank
def fact_balance_account(tables: Tables) -> DataFrame:
    return summaries.build_account_balance(tables, RUN, *spans(tables))


@over_bank
def fact_balance_member(tables: Tables) -> DataFrame:
    return summaries.build_member_balance(tables, RUN, *spans(tables))


# Of the older ledgers: rows after these days had not come, nor those of one late month; another month had other rows.
LEDGER_BEFORE = {"loan_txn": (date(2001, 9, 10), "1998-03", "1999-07"), "subaccount_txn": (date(2024, 1, 24), "2024-01", "2024-01")}


def _ledger_before(tables: Tables, ledger: Ledger) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A ledger as it was, and the rows that changed since, as they are and as they were.

    Rows after a day came later, and in one month every third row of a line came late. In another month fifth rows of a line
    had another balance, and sixth ones had not been posted.
    """
    end, late_month, other_month = LEDGER_BEFORE[ledger.txns]
    line, month = F.pmod("seq", F.lit(10)), F.date_format("date", "yyyy-MM")
    txns = tables[ledger.txns]
    came = (F.col("date") > F.lit(end)) | ((month == late_month) & (line == 3))
    changed = (month == other_month) & line.isin(5, 6)
    known = txns.filter(~F.coalesce(came, F.lit(False)))
    was = known.filter(F.coalesce(changed, F.lit(False))).withColumns(
        {
            "balance": F.when(line == 5, F.col("balance") + 1).otherwise(F.col("balance")),
            "status": F.when(line == 6, "PENDING").otherwise(F.col("status")),
        }
    )
    before = known.filter(~F.coalesce(changed, F.lit(False))).unionByName(was)
    return before, txns.filter(F.coalesce(came | changed, F.lit(False))), was


@over_folder
def fact_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after a refresh of an older one: new days, late rows, changed balances and postings."""
    tables = bank_tables(spark, folder)
    older, touched, old_spans = {}, [], []
    for ledger, start in ((LOANS, LOAN_START), (DEPOSITS, DEPOSIT_START)):
        before, now, was = _ledger_before(tables, ledger)
        older[ledger.txns] = before
        touched.append(sinks.touched_holders(ledger, now, was))
        old_spans.append(facts.ledger_span({ledger.txns: before}, ledger, start))
    then = TableSet(lambda name: older[name] if name in older else tables[name], lambda: sorted(tables))
    root = new_folder(spark, "fact")
    sinks.create_fact(spark, then, RUN, *old_spans, root, "older")
    sinks.refresh_fact(spark, tables, touched[0].unionByName(touched[1]), RUN, *spans(tables), root, "newer")
    return sinks.read_fact(spark, root)


# --- audit queries -------------------------------------------------------------------------------


@over_bank
def audit_company(tables: Tables) -> DataFrame:
    return audit.audit_company(tables, RUN)


@over_bank
def audit_member(tables: Tables) -> DataFrame:
    return audit.audit_member(tables, RUN)


@over_bank
def audit_account(tables: Tables) -> DataFrame:
    return audit.audit_account(tables, RUN)


@over_bank
def audit_bridge(tables: Tables) -> DataFrame:
    return audit.audit_bridge(tables, RUN)


@over_bank
def audit_subaccount(tables: Tables) -> DataFrame:
    return audit.audit_subaccount(tables, RUN)


@over_bank
def audit_fact(tables: Tables) -> DataFrame:
    return audit.audit_balance(tables, RUN, *spans(tables))


@over_bank
def reconcile_fact(tables: Tables) -> DataFrame:
    """Builder balances against audit balances, over both ledgers."""
    return audit.reconcile_balance(tables, RUN, *spans(tables))


@over_folder
def reconcile_dims(spark: SparkSession, folder: str) -> DataFrame:
    tables = bank_tables(spark, folder)
    return audit.reconcile_warehouse(tables, build_warehouse(spark, tables, RUN, *spans(tables)), RUN)


# --- constraints ---------------------------------------------------------------------------------


@over_folder
def check_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = TableSet.from_directory(spark, folder)["lineitem"]
    return ops.check_primary_key(lines, ["l_orderkey", "l_linenumber"])


@over_bank
def check_not_null(tables: Tables) -> DataFrame:
    return ops.check_not_null(tables["loan_txn"], ["loan_id", "date", "balance", "status", "deleted_at"])


@over_bank
def check_foreign_key(tables: Tables) -> DataFrame:
    """Sub-accounts whose account, company and client name no account."""
    return ops.check_foreign_key(tables["subaccount"], ["account_id"], tables["account"], ["id"])


@over_bank
def check_foreign_key_composite(tables: Tables) -> DataFrame:
    """Bridge rows whose member, client and company name no member of the dimension."""
    return ops.check_foreign_key(
        bridge_unfiltered(tables),
        ["member_id", "client_id", "company_id"],
        dim_member(tables),
        ["member_id", "client_id", "company_id"],
    )


@over_bank
def check_unique(tables: Tables) -> DataFrame:
    return ops.check_unique(tables["loan_txn"], ["date"])


@over_bank
def apply_defaults(tables: Tables) -> DataFrame:
    """Posted transactions of both ledgers fitted to the transactions fact: the currency column is absent."""
    loans, deposits = (
        facts.ledger_txns(tables, ledger).select(
            F.col("seq").alias("transaction_id"),
            F.lit(RUN.client_id).alias("client_id"),
            prefixed_key(ledger.prefix, ledger.txn_holder).alias("subaccount_id"),
            F.col("created_at").alias("timestamp"),
            F.col("date").alias("id_date"),
            "status",
            "balance",
        )
        for ledger in (LOANS, DEPOSITS)
    )
    return conform(loans.unionByName(deposits), TARGETS["fact_transactions"], RUN.run_ts)


@over_bank
def rejects(tables: Tables) -> DataFrame:
    """Sub-accounts the target cannot take, with the required columns they leave empty."""
    rejected = ops.split_rejects(dim_subaccount(tables), TARGETS["dim_subaccount"].not_null)[1]
    return rejected.select("subaccount_id", "account_id", "company_id", "missing")


@over_folder
def constraint_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All constraints over tables written once; the fact as intervals, none of its days."""
    tables = bank_tables(spark, folder)
    loans, deposits = spans(tables)
    built = build_warehouse(spark, tables, RUN, loans, deposits)
    fact = "fact_balance_subaccount"
    written = {name: kept(df, name) for name, df in built.items() if name != fact}
    intervals = facts.fact_intervals(tables, LOANS, loans).unionByName(facts.fact_intervals(tables, DEPOSITS, deposits))
    keyed = intervals.withColumn("client_id", F.lit(RUN.client_id))
    return audit_constraints(written, {fact: kept(keyed, "intervals")})


# --- copies and dictionaries ---------------------------------------------------------------------


def _order_changes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An older copy of the orders, changes that overlap it, with keys that repeat, and changes without a key.

    The changes raise prices and empty the priority of partly filled orders; finished orders come with an older
    version too, and urgent ones once more without their key. Rows without a key are not versions of each other.
    """
    orders = TableSet.from_directory(spark, folder)["orders"]
    copy = orders.filter(F.col("o_orderdate") < F.lit(date(2000, 1, 1)))
    newer = orders.filter(F.col("o_orderdate") >= F.lit(date(1997, 1, 1))).withColumns(
        {
            "o_totalprice": F.col("o_totalprice") + 1,
            "o_orderpriority": F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")),
        }
    )
    older = newer.filter(F.col("o_orderstatus") == "F").withColumns(
        {"o_totalprice": F.col("o_totalprice") + 100, "o_orderdate": F.col("o_orderdate") - F.expr("interval 1 day")}
    )
    keyless = newer.filter(F.col("o_orderpriority") == "1-URGENT").withColumn("o_orderkey", F.lit(None).cast("long"))
    return copy, newer.unionByName(older), keyless


@over_folder
def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    copy, versions, keyless = _order_changes(spark, folder)
    newest = ops.latest_version(versions, "o_orderkey", ["o_orderdate"])
    return ops.upsert(copy, newest.unionByName(keyless), key="o_orderkey")


@over_folder
def insert_if_absent(spark: SparkSession, folder: str) -> DataFrame:
    """New keys come several times; the first by date is added."""
    copy, versions, keyless = _order_changes(spark, folder)
    return ops.insert_if_absent(copy, versions.unionByName(keyless), key="o_orderkey", order=["o_orderdate"])


@over_bank
def latest_change(tables: Tables) -> DataFrame:
    """Newest version per sub-account of its whole change history."""
    return ops.latest_version(tables["subaccount_txn"], "subaccount_id", ["created_at", "seq"])


def _items(tables: Tables) -> DataFrame:
    return ops.dictionary_items({name: tables[name] for name in DICTIONARIES})


@over_bank
def dictionary_items(tables: Tables) -> DataFrame:
    return _items(tables)


@over_bank
def dictionary_attrs(tables: Tables) -> DataFrame:
    return ops.dictionary_attributes(_items(tables))


@over_bank
def dictionary_counts(tables: Tables) -> DataFrame:
    return ops.dictionary_counts(_items(tables))
