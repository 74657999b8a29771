"""Step functions: sums, key checks and reconciliation on intervals against the same over spelled-out days."""

import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_warehouse import SMALL, SPAN, tiny_bank

from daybook import operators as ops
from daybook import sinks
from daybook.catalogue import catalogue
from daybook.plans import TARGETS, Run, Span, audit_constraints, build_warehouse, facts, interval_violations, summaries
from daybook.plans import audit
from daybook.plans.dimensions import LOANS
from daybook.sinks.buckets import TASK_BYTES, Directory, write_buckets
from daybook.sources import TableSet

FIRST = date(2024, 1, 1)
STEPS = "k string, first_day date, last_day date, v decimal(18,2)"


def day(n):
    return FIRST + timedelta(days=n)


def steps(spark, data):
    return spark.createDataFrame([(k, day(a), day(a + n), Decimal(v)) for k, a, n, v in data], STEPS)


def spelled(data):
    """{(key, day): [values that hold there]}"""
    held = defaultdict(list)
    for k, a, n, v in data:
        for d in range(a, a + n + 1):
            held[k, day(d)].append(Decimal(v))
    return held


DATA = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 8), st.integers(0, 5), st.integers(-2, 2)), max_size=12)
QUICK = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@QUICK
@given(data=DATA)
def test_sums_by_definition(spark, data):
    summed = ops.steps_of(ops.changes(steps(spark, data), ["k"], ["v"]), ["k"], ["v"]).filter("cover > 0")
    found = {(r.k, r.first_day + timedelta(days=i)): (r.v, r.cover) for r in summed.collect() for i in range((r.last_day - r.first_day).days + 1)}
    assert found == {key: (sum(values), len(values)) for key, values in spelled(data).items()}


@QUICK
@given(data=DATA)
def test_key_check_by_definition(spark, data):
    broken = ops.check_interval_key(steps(spark, data), ["k"])
    found = sum(r.n for r in broken.select(ops.days_in().alias("n")).collect())
    assert found == sum(len(values) > 1 or k is None for (k, _), values in spelled(data).items())


@QUICK
@given(actual=DATA, expected=DATA)
def test_reconciled_steps_equal_reconciled_days(spark, actual, expected):
    found = ops.reconcile_steps(steps(spark, actual), steps(spark, expected), ["k"], "v", "v")
    a, e = spelled(actual), spelled(expected)
    both = [(a.get(k, []), e.get(k, [])) for k in a | e]
    one = [(x, y) for x, y in both if len(x) == len(y) == 1]
    want = {
        "missing": sum(not x for x, _ in both),
        "unexpected": sum(not y for _, y in both),
        "duplicate": sum(len(x) > 1 or len(y) > 1 for x, y in both),
        "compared": len(one),
        "mismatch": sum(x != y for x, y in one),
    }
    assert {r.metric: r.n for r in found.collect()} == want


def test_intervals_as_steps_hold_what_their_days_hold(spark):
    schema = "k int, first_day date, value_day date, last_day date, balance decimal(18,2), carried decimal(18,2)"
    data = [(1, 0, 2, 5, 7, 7), (2, 0, 2, 5, 7, 9), (3, 3, 3, 3, 1, 4), (4, 0, 6, 5, None, None), (5, 2, 2, 4, 0, 3)]
    intervals = spark.createDataFrame(
        [(k, day(a), day(b), day(c), *(None if v is None else Decimal(v) for v in vs)) for k, a, b, c, *vs in data], schema
    )
    as_days = ops.as_steps(intervals).select("k", F.explode(F.sequence("first_day", "last_day")).alias("date"), "balance")
    assert rows(as_days) == rows(ops.expand_days(intervals))


def test_sums_spell_nothing_out_before_the_last_shuffle(spark, data):
    for name in ("fact_balance_account", "fact_balance_member"):
        plan = physical_plan(catalogue()[name](spark, data))
        days = plan.index("sequence(")
        assert "Exchange" not in plan[:days]


def test_interval_audits_and_reconciliation_never_see_a_day(spark, data):
    plan = physical_plan(catalogue()["reconcile_fact"](spark, data))
    assert "sequence(" not in plan and "Generate explode(array(" in plan
    assert "sequence(" not in physical_plan(catalogue()["constraint_audit"](spark, data))


@pytest.fixture
def family(spark):
    """Account 1 has two loans and a deposit; members 1 and 2 share it, member 1 by two links, one ended link aside."""
    txns = "loan_id int, date date, created_at timestamp_ntz, seq int, balance double, status string, deleted_at timestamp_ntz"
    loans = [(1, 1, 1.0), (1, 3, 4.0), (2, 2, 10.0), (3, 1, 100.0)]
    return tiny_bank(
        spark,
        account=spark.createDataFrame([(1, 10), (2, 10)], "id int, institution_id int"),
        member=spark.createDataFrame(
            [(1, 1, 10, None, None), (2, 1, 10, None, None)],
            "id int, sub_role_id int, institution_id int, created_at string, deleted_at string",
        ),
        member_account=spark.createDataFrame(
            [(n, m, a, 1, True, None, end) for n, (m, a, end) in enumerate([(1, 1, None), (1, 1, None), (2, 1, None), (2, 2, "2024-01-01")])],
            "id int, member_id int, account_id int, ownership_type_id int, is_primary boolean, created_at string, deleted_at string",
        ),
        loan=spark.createDataFrame(
            [(1, 1, 1, 0.0, None, None), (2, 1, 1, 0.0, None, None), (3, 2, 1, 0.0, None, None), (4, None, 1, 0.0, None, None)],
            "id int, account_id int, account_type_id int, current_balance double, created_at string, deleted_at string",
        ),
        loan_txn=spark.createDataFrame(
            [(n, date(2024, 1, d), datetime(2024, 1, d), d, b, None, None) for n, d, b in [*loans, (4, 1, 9.0)]], txns
        ),
    )


def test_accounts_add_up_their_holders_and_members_their_accounts(spark, family):
    # Deposit 1 of account 1 holds 3 on all of its days, one more than the loans have.
    deposits = Span(date(2024, 1, 1), date(2024, 1, 4))
    accounts = summaries.build_account_balance(family, SMALL, SPAN, deposits)
    found = {(r.account_id, r.date.day): r.current_balance for r in accounts.collect()}
    assert found == {
        **{("INT1", d): Decimal(v) for d, v in ((1, 4), (2, 14), (3, 17), (4, 3))},
        **{("INT2", d): Decimal(100) for d in (1, 2, 3)},
    }
    members = summaries.build_member_balance(family, SMALL, SPAN, deposits)
    found = {(r.member_id, r.date.day): r.current_balance for r in members.collect()}
    assert found == {(m, d): Decimal(v) for m in "12" for d, v in ((1, 4), (2, 14), (3, 17), (4, 3))}
    days = facts.build_balance(family, SMALL, SPAN, deposits).filter("account_id is not null")
    by_day = days.groupBy("account_id", "client_id", "company_id", "date").agg(F.sum("current_balance").alias("b"))
    assert rows(by_day) == rows(accounts.select("account_id", "client_id", "company_id", "date", "current_balance"))


def test_summaries_are_published_with_the_warehouse(spark, family, tmp_path):
    root = str(tmp_path / "w")
    sinks.load_warehouse(spark, family, SMALL, SPAN, SPAN, root, "v1", schemas=None)
    published = sinks.read_summaries(spark, root)
    built = summaries.build_account_balance(family, SMALL, SPAN, SPAN).filter("company_id is not null")
    assert rows(published["fact_balance_account"]) == rows(built)
    assert published["fact_balance_member"].count() == 6


def test_interval_violations_equal_those_of_days(spark):
    bank = tiny_bank(spark)
    twice = tiny_bank(spark, loan=bank["loan"].union(bank["loan"].filter("id = 1")))
    built = build_warehouse(spark, twice, SMALL, SPAN, SPAN)
    kinds = [facts.fact_intervals(twice, ledger, SPAN) for ledger in (LOANS, facts.DEPOSITS)]
    intervals = kinds[0].unionByName(kinds[1]).withColumn("client_id", F.lit(1))
    name = "fact_balance_subaccount"
    days = audit_constraints({n: df for n, df in built.items()}).filter(F.col("target") == name)
    found = interval_violations(name, intervals, built)
    assert rows(found) == rows(days) and found.filter("kind = 'primary_key' and broken = 9").count() == 1


# --- carried-in balances -------------------------------------------------------------------------

TXN = "e int, date date, created_at timestamp_ntz, seq int, balance decimal(18,2)"


def txns(spark, data):
    return spark.createDataFrame([(e, d and day(d), datetime(2024, 1, 1), i, b and Decimal(b)) for i, (e, d, b) in enumerate(data)], TXN)


def test_carry_in_opens_with_what_held_before(spark):
    data = [(1, 1, 5), (1, 2, 7), (1, 2, None), (1, 6, 9), (2, 3, 4), (3, 6, 8), (4, 1, None), (5, 4, 2), (None, 1, 3), (6, 20, 1)]
    found = defaultdict(list)
    for r in ops.daily_balance(txns(spark, data), "e", day(4), day(7), carry_in=True).orderBy("date").collect():
        found[r.e].append(int(r.balance))
    # Day 2 of entity 1 ends without a balance, so day 1 holds until day 6.
    assert found == {
        1: [5, 5, 9, 9], 2: [4] * 4, 3: [0, 0, 8, 8], 4: [0] * 4, 5: [2] * 4, None: [0] * 4, 6: [0] * 4,
    }


@QUICK
@given(data=st.lists(st.tuples(st.sampled_from([1, 2, None]), st.integers(1, 9), st.none() | st.integers(1, 9)), max_size=14))
def test_carry_in_is_a_longer_series_cut_at_its_start(spark, data):
    frame = txns(spark, data)
    long = ops.daily_balance(frame, "e", day(0), day(9)).filter(F.col("date") >= F.lit(day(5)))
    assert rows(ops.daily_balance(frame, "e", day(5), day(9), carry_in=True)) == rows(long)
    cut = ops.daily_intervals(frame, "e", day(5), day(9), carry=ops.carry_max, carry_in=True)
    whole = ops.expand_days(ops.daily_intervals(frame, "e", day(0), day(9), carry=ops.carry_max))
    assert rows(ops.expand_days(cut)) == rows(whole.filter(F.col("date") >= F.lit(day(5))))


# --- the fact, refreshed -------------------------------------------------------------------------

LOAN_TXN = "loan_id bigint, date date, created_at timestamp_ntz, seq bigint, balance double, status string, deleted_at timestamp_ntz"
START, END = date(2024, 1, 1), date(2024, 6, 30)


def ledger(spark, data):
    return spark.createDataFrame(
        [(h, d, datetime(2024, 1, 1), s, b, status, None) for h, d, s, b, status in data], LOAN_TXN
    )


def bank_of(spark, data, **more):
    return tiny_bank(spark, loan_txn=ledger(spark, data), **more)


BEFORE = [
    (1, date(2024, 1, 10), 1, 10.0, None),
    (1, date(2024, 5, 10), 2, 50.0, None),
    (2, date(2024, 2, 5), 3, 20.0, None),
    (3, date(2024, 3, 5), 4, 30.0, None),
    (None, date(2024, 3, 5), 5, 1.0, None),
]
RUNS = Run(1, datetime(2024, 2, 1))
MONTHS = [f"2024-0{m}-01" for m in range(1, 7)]


@pytest.fixture
def store(spark, tmp_path):
    """A fact of the ledger before, and what a refresh to another ledger makes of it."""
    root = str(tmp_path / "fact")
    span = Span(START, END)
    assert sinks.create_fact(spark, bank_of(spark, BEFORE), RUNS, span, span, root, "v1", bucket_bytes=200) == MONTHS

    def files():
        found = defaultdict(set)
        for f in sinks.read_fact(spark, root).inputFiles():
            found[f.split("month=")[1][:10]].add(f)
        return found

    def refresh(after, version="v2", end=END, **more):
        bank, old = bank_of(spark, after, **more), files()
        changed = [r for r in after if r not in BEFORE], [r for r in BEFORE if r not in after]
        touched = sinks.touched_holders(LOANS, *(ledger(spark, c) for c in changed))
        span = Span(START, end)
        months = sinks.refresh_fact(spark, bank, touched, RUNS, span, span, root, version, bucket_bytes=200)
        assert rows(sinks.read_fact(spark, root)) == rows(facts.build_balance(bank, RUNS, span, span))
        now = files()
        assert {m for m in old.keys() | now.keys() if old.get(m) != now.get(m)} == set(months)
        return months

    return refresh


def test_a_late_row_writes_the_months_it_changes(store):
    assert store([*BEFORE, (1, date(2024, 2, 20), 9, 15.0, None)]) == MONTHS[1:5]


def test_a_late_row_of_the_same_balance_writes_nothing(store):
    assert store([*BEFORE, (1, date(2024, 2, 20), 9, 10.0, None)]) == []


def test_rows_before_the_series_or_without_a_balance_write_nothing(store):
    assert store([*BEFORE, (1, date(2023, 2, 20), 9, 15.0, None), (1, date(2024, 2, 20), 9, None, None)]) == []


def test_a_changed_balance_and_one_withdrawn(store):
    after = [(1, date(2024, 1, 10), 1, 11.0, None), *BEFORE[1:2], (2, date(2024, 2, 5), 3, 20.0, "PENDING"), *BEFORE[3:]]
    # Holder 2 has no transaction that counts any more, so all of its days go.
    assert store(after) == MONTHS


def test_a_withdrawn_balance_falls_back_to_the_one_before(store):
    assert store([r for r in BEFORE if r[2] != 2]) == MONTHS[4:]


def test_a_new_holder_and_one_without_id(store):
    assert store([*BEFORE, (7, date(2024, 6, 2), 9, 15.0, None)]) == MONTHS
    assert store([r for r in [*BEFORE, (7, date(2024, 6, 2), 9, 15.0, None)] if r[0] is not None], "v3") == MONTHS


def test_later_ends_write_the_new_days_only(store):
    after = [*BEFORE, (2, date(2024, 7, 3), 9, 21.0, None)]
    assert store(after, end=date(2024, 8, 2)) == ["2024-06-01", "2024-07-01", "2024-08-01"]
    with pytest.raises(ValueError, match="only end later"):
        store(after, "v3", end=END)


def test_a_holder_that_moved_is_written_anew(spark, store):
    holders = "id int, account_id int, account_type_id int, current_balance double, created_at string, deleted_at string"
    loans = [(1, 1, 1, 0.0, None, None), (2, 3, 1, 0.0, None, None), (3, 1, 1, 0.0, None, None)]
    assert store(BEFORE, loan=spark.createDataFrame(loans, holders)) == MONTHS


def test_refreshes_add_up_and_labels_are_used_once(spark, store):
    late = (3, date(2024, 4, 20), 9, 31.0, None)
    assert store([*BEFORE, late]) == MONTHS[3:]
    assert store([*BEFORE, late, (3, date(2024, 4, 10), 10, 29.0, None)], "v3") == MONTHS[3:4]
    with pytest.raises(sinks.VersionExists):
        store(BEFORE, "v3")


def test_points_of_untouched_buckets_keep_their_files(spark, tmp_path):
    root, span = str(tmp_path / "fact"), Span(START, END)
    many = [(h, date(2024, 1 + h % 6, 3), h, float(h), None) for h in range(200)]
    sinks.create_fact(spark, bank_of(spark, many), RUNS, span, span, root, "v1", bucket_bytes=1500)
    before = sinks.latest_commit(spark, root).parts
    late = (5, date(2024, 2, 9), 999, 1.0, None)
    touched = sinks.touched_holders(LOANS, ledger(spark, [late]))
    sinks.refresh_fact(spark, bank_of(spark, [*many, late]), touched, RUNS, span, span, root, "v2", bucket_bytes=1 << 20)
    after = sinks.latest_commit(spark, root).parts
    assert len(before) > 2 and set(after) == set(before) and Counter(after[b] != before[b] for b in before)[True] == 1


def test_an_empty_ledger_has_an_empty_fact(spark, tmp_path):
    root, span = str(tmp_path / "fact"), Span(START, END)
    bank = bank_of(spark, [], subaccount_txn=tiny_bank(spark)["subaccount_txn"].limit(0))
    sinks.create_fact(spark, bank, RUNS, span, span, root, "v1")
    assert sinks.read_fact(spark, root).collect() == []
    touched = sinks.touched_holders(LOANS, ledger(spark, BEFORE))
    full = bank_of(spark, BEFORE, subaccount_txn=tiny_bank(spark)["subaccount_txn"].limit(0))
    sinks.refresh_fact(spark, full, touched, RUNS, span, span, root, "v2")
    assert rows(sinks.read_fact(spark, root)) == rows(facts.build_balance(full, RUNS, span, span))


def test_series_end_with_their_ledger(spark):
    bank = tiny_bank(spark)
    assert facts.ledger_span(bank, LOANS, date(2023, 5, 1)) == Span(date(2023, 5, 1), date(2024, 1, 2))
    assert facts.ledger_span(bank, LOANS, date(2025, 5, 1)) == Span(date(2025, 5, 1), date(2025, 5, 1))
    empty = TableSet.from_frames({LOANS.txns: bank[LOANS.txns].limit(0)})
    assert facts.ledger_span(empty, LOANS, START) == Span(START, START)
    assert set(TARGETS) & set(summaries.SUMMARIES) == set()


def test_a_bucket_of_many_bytes_is_written_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "points")
    rows_ = spark.range(4000).withColumn("v", F.col("id") * 2)
    write_buckets(rows_, Directory({2: 0, 3: 0}), ("id",), {2: 4 * TASK_BYTES, 3: 10}, path)
    files = {b: len(list((tmp_path / "points" / f"__bucket={b}").glob("*.parquet"))) for b in (2, 3)}
    assert files == {2: 4, 3: 1}
    assert rows(spark.read.parquet(path).select("id", "v")) == rows(rows_)


def test_expected_bytes_are_shared_by_the_buckets_that_split():
    directory = Directory({2: 50, 3: 40}).split({2: 500}, 250)
    assert directory.expected({2: 500, 3: 60}) == {4: 250, 6: 250, 3: 60}


def test_days_of_a_fact_are_written_by_tasks_that_follow_their_number(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("daybook.operators.balances.TASK_ROWS", 10)
    span, root = Span(day(0), day(59)), str(tmp_path / "fact")
    bank = bank_of(spark, BEFORE)
    sinks.create_fact(spark, bank, RUNS, span, span, root, "v1")
    assert len(sinks.read_fact(spark, root).inputFiles()) > 8
    assert rows(sinks.read_fact(spark, root)) == rows(facts.build_balance(bank, RUNS, span, span))


def test_steps_of_both_sides_are_dealt_by_their_number(spark, data, monkeypatch):
    found = rows(catalogue()["reconcile_fact"](spark, data))
    monkeypatch.setattr("daybook.operators.balances.TASK_ROWS", 1000)
    frame = catalogue()["reconcile_fact"](spark, data)
    dealt = [int(n) for n in re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", physical_plan(frame))]
    # Two ledgers on each side, and both sides together.
    assert len(dealt) == 5 and max(dealt) > 20 and rows(frame) == found


def test_audited_days_are_dealt_by_their_number(spark, data, monkeypatch):
    monkeypatch.setattr("daybook.operators.balances.TASK_ROWS", 1000)
    frame = catalogue()["audit_fact"](spark, data)
    sizes = [r.n for r in frame.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 10 * 2469 + 15 * 28 and len(sizes) > 20
    # The spine, the last of each day and the joined days of two ledgers.
    assert physical_plan(frame).count("REPARTITION_BY_NUM") >= 6


def test_the_audit_opens_every_series_with_nothing(spark):
    """A holder without an amount in the span, one whose first amount is late, and transactions without a holder."""
    txn = "loan_id int, date date, created_at timestamp_ntz, seq int, balance double, status string, deleted_at timestamp_ntz"
    data = [(1, 2, 5.0), (1, 2, 7.0), (1, 4, 6.0), (2, 40, 1.0), (2, 3, None), (None, 2, 9.0)]
    stamped = [(n, day(d), datetime(2024, 1, 1) + timedelta(d), i, v, None, None) for i, (n, d, v) in enumerate(data)]
    bank = tiny_bank(spark, loan_txn=spark.createDataFrame(stamped, txn))
    found = audit._audit_steps(bank, LOANS, Span(day(1), day(6)))
    days = found.select("holder", F.explode(F.sequence("first_day", "last_day")).alias("date"), F.col("held").alias("balance"))
    assert rows(days) == rows(audit._audit_series(bank, LOANS, Span(day(1), day(6)))) and days.count() == 18
