"""Independent audit queries: each derives a warehouse table again from the source tables, in a simpler way.

Nothing here uses the builders' joins or intervals, so a fault there shows as a difference. The audits also differ from the builders where
the audited business rule does: the client id is text, company ids keep their source type, bridge account ids carry
no prefix, balances are doubles, all transactions count, and gaps hold the running maximum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import lifecycle_status, prefixed_key
from daybook.operators.balances import partitions_for
from daybook.operators.reconcile import reconcile, reconcile_steps
from daybook.operators.steps import as_steps
from daybook.plans.dimensions import DEPOSITS, LOANS, Ledger, Run, Tables
from daybook.plans.facts import Span, ledger_intervals


def audit_company(tables: Tables, run: Run) -> DataFrame:
    institution, company = tables["institution"].alias("i"), tables["company"].alias("c")
    return institution.join(company, F.col("i.company_id") == F.col("c.id"), "left").select(
        F.col("i.id").alias("company_id"), F.lit(str(run.client_id)).alias("client_id"), F.col("c.name").alias("name")
    )


def audit_member(tables: Tables, run: Run) -> DataFrame:
    member, sub_role, role = tables["member"].alias("m"), tables["sub_role"].alias("s"), tables["role"].alias("r")
    joined = member.join(sub_role, F.col("m.sub_role_id") == F.col("s.id"), "left")
    joined = joined.join(role, F.col("s.role_id") == F.col("r.id"), "left").filter(F.col("r.type") == "MEMBER")
    return joined.select(
        F.col("m.id").alias("member_id"),
        F.col("m.institution_id").alias("company_id"),
        F.lit(str(run.client_id)).alias("client_id"),
        "m.created_at",
        "m.deleted_at",
        lifecycle_status("m.deleted_at").alias("status"),
    )


def audit_account(tables: Tables, run: Run) -> DataFrame:
    return tables["account"].select(
        prefixed_key("INT", "id").alias("account_id"),
        F.col("institution_id").alias("company_id"),
        F.lit(str(run.client_id)).alias("client_id"),
        F.lit("Internal").alias("internal_external"),
    )


def audit_bridge(tables: Tables, run: Run) -> DataFrame:
    """Links of every member with the audited ownership, not only of those in the member dimension."""
    link, kind, member = tables["member_account"].alias("l"), tables["ownership_type"].alias("o"), tables["member"].alias("m")
    joined = link.join(kind, F.col("l.ownership_type_id") == F.col("o.id"), "left").filter(F.col("o.type") == "MEMBER")
    return joined.join(member, F.col("l.member_id") == F.col("m.id"), "left").select(
        "l.member_id",
        "l.account_id",
        F.col("m.institution_id").alias("company_id"),
        F.lit(str(run.client_id)).alias("client_id"),
        F.col("o.key").alias("ownership_type"),
        "l.is_primary",
        lifecycle_status("l.deleted_at").alias("status"),
        "l.created_at",
        "l.deleted_at",
    )


def _audit_subaccount_of(tables: Tables, run: Run, ledger: Ledger) -> DataFrame:
    joined = (
        tables[ledger.holders]
        .alias("h")
        .join(tables["account"].alias("a"), F.col("h.account_id") == F.col("a.id"), "left")
        .join(tables["institution"].alias("i"), F.col("a.institution_id") == F.col("i.id"), "left")
        .join(tables["company"].alias("c"), F.col("i.company_id") == F.col("c.id"), "left")
        .join(tables["account_type"].alias("t"), F.col("h.account_type_id") == F.col("t.id"), "left")
    )
    return joined.select(
        prefixed_key(ledger.prefix, "h.id").alias("subaccount_id"),
        prefixed_key("INT", "h.account_id").alias("account_id"),
        F.lit(str(run.client_id)).alias("client_id"),
        F.col("a.institution_id").alias("company_id"),
        F.col("c.name").alias("company_name"),
        F.lit("Internal").alias("internal_or_external"),
        lifecycle_status("h.deleted_at").alias("status"),
        F.col("t.value").alias("default_type"),
        F.lit("").alias("custom_type"),
        F.lit(ledger.side).alias("default_asset_liability"),
        F.lit("").alias("custom_asset_liability"),
        F.col(f"h.{ledger.amount}").alias("current_balance"),
        F.col("h.created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("h.deleted_at").cast("timestamp_ntz").alias("deleted_at"),
    )


def audit_subaccount(tables: Tables, run: Run) -> DataFrame:
    return _audit_subaccount_of(tables, run, LOANS).unionByName(_audit_subaccount_of(tables, run, DEPOSITS))


def _audit_series(tables: Tables, ledger: Ledger, span: Span) -> DataFrame:
    """Every holder with transactions on every day, by spine, join and window; an audit may shuffle days.

    It deals them to partitions that follow their number. Adaptive execution would merge those: days of a series compress to
    a small part of what they take when they are sorted; and it would spell out the spine of all holders in one task.
    """
    txns = tables[ledger.txns].select(
        F.col(ledger.txn_holder).alias("holder"), "date", "created_at", "seq", F.col("balance").cast("double").alias("amount")
    )
    newest = [F.col(c).desc_nulls_last() for c in ("created_at", "seq", "amount")]
    nth = F.row_number().over(Window.partitionBy("holder", "date").orderBy(*newest))
    in_span = F.col("date").between(F.lit(span.start), F.lit(span.end)) & F.col("holder").isNotNull()
    last = txns.filter(in_span).withColumn("nth", nth).filter("nth = 1").select("holder", "date", "amount")
    parts = partitions_for(txns, _series_days(tables, ledger, span))
    days = F.explode(F.sequence(F.lit(span.start), F.lit(span.end))).alias("date")
    spine = txns.select("holder").distinct().repartition(parts, "holder").select("holder", days)
    by_day = (side.repartition(parts, "holder", "date") for side in (spine, last))
    so_far = Window.partitionBy("holder").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.coalesce("amount", F.max("amount").over(so_far), F.lit(0.0))
    series = next(by_day).join(next(by_day), ["holder", "date"], "left").repartition(parts, "holder")
    return series.select("holder", "date", held.alias("balance"))


def _series_days(tables: Tables, ledger: Ledger, span: Span) -> int:
    """About how many days the series of all holders have."""
    holders = tables[ledger.txns].agg(F.approx_count_distinct(ledger.txn_holder).alias("n")).first().n
    return holders * ((span.end - span.start).days + 1)


def _accounts_of_holders(tables: Tables, ledger: Ledger) -> DataFrame:
    """``id, account_id, institution_id`` of each holder, so that series, which are large, meet one table only."""
    holder, account = tables[ledger.holders].alias("h"), tables["account"].alias("a")
    return holder.join(account, F.col("h.account_id") == F.col("a.id"), "left").select("h.id", "h.account_id", "a.institution_id")


def _audit_balance_of(tables: Tables, run: Run, ledger: Ledger, span: Span) -> DataFrame:
    series = _audit_series(tables, ledger, span).alias("s")
    joined = series.join(_accounts_of_holders(tables, ledger).alias("h"), F.col("s.holder") == F.col("h.id"), "left")
    return joined.select(
        prefixed_key(ledger.prefix, "s.holder").alias("subaccount_id"),
        prefixed_key("INT", "h.account_id").alias("account_id"),
        F.lit(run.client_id).alias("client_id"),
        F.col("h.institution_id").alias("company_id"),
        "s.date",
        "s.balance",
    )


def _audit_days(tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    return _audit_balance_of(tables, run, LOANS, loans).unionByName(_audit_balance_of(tables, run, DEPOSITS, deposits))


def audit_balance(tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    """Daily balances over all transactions with running-maximum gaps, by sub-account and day."""
    days = _audit_days(tables, run, loans, deposits)
    parts = partitions_for(days, sum(_series_days(tables, *of) for of in ((LOANS, loans), (DEPOSITS, deposits))))
    order = F.col("subaccount_id").asc_nulls_last(), F.col("date").asc_nulls_last()
    return days.repartitionByRange(parts, *order).sortWithinPartitions(*order)


def _audit_steps(tables: Tables, ledger: Ledger, span: Span) -> DataFrame:
    """The audited series of every holder as steps, by windows of its own over last-of-day values.

    On a day with an amount that amount holds, after it the largest so far, before the first one nothing.
    """
    txns = tables[ledger.txns].select(
        F.col(ledger.txn_holder).alias("holder"), "date", "created_at", "seq", F.col("balance").cast("double").alias("amount")
    )
    newest = [F.col(c).desc_nulls_last() for c in ("created_at", "seq", "amount")]
    nth = F.row_number().over(Window.partitionBy("holder", "date").orderBy(*newest))
    in_span = F.col("date").between(F.lit(span.start), F.lit(span.end)) & F.col("holder").isNotNull()
    last = txns.filter(in_span).withColumn("nth", nth).filter("nth = 1 AND amount IS NOT NULL")
    # A row without a day opens the series of each holder; each of the others gives two steps, of two borders each.
    opening = txns.select("holder").distinct()
    rows = last.select("holder", "date", "amount").unionByName(opening, allowMissingColumns=True)
    by_day = Window.partitionBy("holder").orderBy(F.col("date").asc_nulls_first())
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = rows.repartition(partitions_for(txns, 4 * tables[ledger.txns].count()), "holder").select(
        "holder",
        "date",
        "amount",
        F.max("amount").over(so_far).alias("top"),
        F.coalesce(F.date_sub(F.lead("date").over(by_day), 1), F.lit(span.end)).alias("until"),
    )

    def step(first: Column, last: Column, value: Column) -> Column:
        return F.struct(first.alias("first_day"), last.alias("last_day"), value.alias("held"))

    before = step(F.lit(span.start), F.col("until"), F.lit(0.0))
    on_day = step(F.col("date"), F.col("date"), F.col("amount"))
    after = step(F.date_add("date", 1), F.col("until"), F.col("top"))
    steps = F.when(F.col("date").isNull(), F.array(before)).otherwise(F.array(on_day, after))
    return held.select("holder", F.explode(steps).alias("step")).select("holder", "step.*").filter("first_day <= last_day")


def reconcile_balance(tables: Tables, run: Run, loans: Span, deposits: Span) -> DataFrame:
    """Builder balances against audit balances, by the fact's key, in days.

    The client is the same on both sides and prefixes are one to one, so source ids stand for the key until the end.
    """
    actual, expected, rows = [], [], 0
    for ledger, span in ((LOANS, loans), (DEPOSITS, deposits)):
        kind = F.lit(ledger.prefix).alias("kind")
        key = ("holder", "account_id", "institution_id")
        built = as_steps(ledger_intervals(tables, ledger, span))
        actual.append(built.select(kind, *key, "first_day", "last_day", "balance"))
        steps, holder = _audit_steps(tables, ledger, span).alias("s"), _accounts_of_holders(tables, ledger).alias("h")
        placed = steps.join(holder, F.col("s.holder") == F.col("h.id"), "left")
        amount = F.col("s.held").cast("decimal(18,2)").alias("balance")
        expected.append(placed.select(kind, "s.holder", "h.account_id", "h.institution_id", "s.first_day", "s.last_day", amount))
        rows += 2 * tables[ledger.txns].count()
    sides = (rows[0].unionByName(rows[1]) for rows in (actual, expected))
    return reconcile_steps(*sides, ["kind", "holder", "account_id", "institution_id"], "balance", "current_balance", rows)


def reconcile_warehouse(tables: Tables, built: Tables, run: Run) -> DataFrame:
    """Builder against audit for every dimension and the bridge: ``dataset`` plus the columns of reconcile.

    Audit rows are first brought to the builders' key types. Members in the bridge without the audited
    role show up as missing there: the audit does not filter them.
    """

    def text(*columns: str) -> dict[str, Column]:
        return {c: F.col(c).cast("string") for c in columns}

    pairs = {
        "company": (
            built["dim_company"],
            audit_company(tables, run).withColumns(text("company_id")),
            ["company_id"],
            ["name"],
        ),
        "member": (
            built["dim_member"],
            audit_member(tables, run).withColumns(text("member_id", "company_id")),
            ["member_id"],
            ["company_id", "status"],
        ),
        "account": (
            built["dim_account"],
            audit_account(tables, run).withColumns(text("company_id")),
            ["account_id"],
            ["company_id", "internal_external"],
        ),
        "subaccount": (
            built["dim_subaccount"],
            audit_subaccount(tables, run).withColumns(
                {**text("company_id"), "current_balance": F.col("current_balance").cast("decimal(18,2)")}
            ),
            ["subaccount_id"],
            ["account_id", "company_id", "company_name", "default_type", "status", "current_balance"],
        ),
        "bridge": (
            built["bridge_member_account"],
            audit_bridge(tables, run).withColumns(
                {**text("member_id", "company_id"), "account_id": prefixed_key("INT", "account_id")}
            ),
            ["member_id", "account_id", "created_at", "ownership_type", "status", "is_primary"],
            ["company_id"],
        ),
    }
    reports = [
        reconcile(*pair).select(F.lit(name).alias("dataset"), "metric", "column_name", "n")
        for name, pair in pairs.items()
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result
