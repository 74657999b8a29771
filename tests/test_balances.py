"""Daily series: hand-made cases, both formulations against each other, and against plain Python."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook import operators as ops

START, END = date(2024, 1, 1), date(2024, 1, 5)
SCHEMA = (
    "entity string, date date, created_at timestamp_ntz, seq int, balance decimal(18,2), "
    "status string, deleted_at timestamp_ntz"
)


def day(n):
    return date(2024, 1, 1) + timedelta(days=n - 1)


def txn(entity, n, balance, hour=12, seq=0, status=None, deleted=None):
    on = day(n)
    created = None if hour is None else datetime(on.year, on.month, on.day, hour)
    amount = None if balance is None else Decimal(str(balance))
    return (entity, on, created, seq, amount, status, deleted)


DELETED = datetime(2024, 1, 9)
CASES = {
    "plain gap": ([(2, 10), (4, 7)], [0, 10, 10, 7, 7]),
    "decrease": ([(1, 9), (3, 4)], [9, 9, 4, 4, 4]),
    "tie on creation time": ([(2, 5, 12, 1), (2, 6, 12, 2)], [0, 6, 6, 6, 6]),
    "tie, larger seq has the smaller value": ([(2, 6, 12, 1), (2, 5, 12, 2)], [0, 5, 5, 5, 5]),
    "tie on all order columns": ([(2, 5, 12, 1), (2, 6, 12, 1)], [0, 6, 6, 6, 6]),
    "null creation time is oldest": ([(2, 8, None), (2, 3, 10)], [0, 3, 3, 3, 3]),
    "latest row without balance": ([(1, 2), (2, 5, 9), (2, None, 10)], [2, 2, 2, 2, 2]),
    "before the start only": ([(0, 50)], [0, 0, 0, 0, 0]),
    "before the start, then in range": ([(0, 50), (3, 4)], [0, 0, 4, 4, 4]),
    "after the end only": ([(9, 50)], [0, 0, 0, 0, 0]),
    "on the first day": ([(1, 1)], [1, 1, 1, 1, 1]),
    "on the last day": ([(5, 1)], [0, 0, 0, 0, 1]),
    "every day": ([(n, n) for n in range(1, 6)], [1, 2, 3, 4, 5]),
    "no balance at all": ([(2, None), (4, None)], [0, 0, 0, 0, 0]),
    "without balance before and after": ([(1, None), (2, 3), (4, None)], [0, 3, 3, 3, 3]),
    "negative": ([(3, -12.34)], [0, 0, -12.34, -12.34, -12.34]),
    "pending and deleted": (
        [(2, 5), (3, 99, 12, 0, "PENDING"), (4, 98, 12, 0, None, DELETED)],
        [0, 5, 5, 5, 5],
    ),
    "only pending": ([(2, 5, 12, 0, "PENDING")], []),
}


def case_txns(spark):
    return spark.createDataFrame([txn(name, *args) for name, (cases, _) in CASES.items() for args in cases], SCHEMA)


def as_series(df):
    series = {}
    for entity, on, balance in sorted(rows(df.select("entity", "date", "balance")), key=lambda r: (str(r[0]), r[1])):
        series.setdefault(entity, {})[on] = balance
    return series


def expected_series():
    return {
        name: {day(i + 1): Decimal(str(v)) for i, v in enumerate(values)}
        for name, (_, values) in CASES.items()
        if values
    }


def joined_spine(txns):
    """Entities x days joined to the last value of each day."""
    spine = ops.entity_spine(ops.active_entities(txns, "entity"), START, END)
    return spine.join(ops.latest_per_day(txns, "entity"), ["entity", "date"], "left")


def spine_and_fill(txns, fill=ops.forward_fill, spine=joined_spine):
    return fill(spine(txns), "entity", "balance")


def gaps_and_fill(txns, fill=ops.forward_fill):
    return spine_and_fill(txns, fill, lambda t: ops.series_with_gaps(t, "entity", START, END))


FORMULATIONS = {
    "gap expansion": lambda txns: ops.daily_balance(txns, "entity", START, END),
    "spine and fill": spine_and_fill,
    "gaps and fill": gaps_and_fill,
}


@pytest.mark.parametrize("formulation", sorted(FORMULATIONS))
def test_hand_made_cases(spark, formulation):
    txns = ops.posted(case_txns(spark))
    result = FORMULATIONS[formulation](txns)
    assert as_series(result) == expected_series()
    assert result.count() == 5 * len(expected_series())


def test_running_max_keeps_the_days_own_value(spark):
    txns = spark.createDataFrame([txn("a", 1, 9), txn("a", 3, 4), txn("b", 2, -5)], SCHEMA)
    expected = {"a": [9, 9, 4, 9, 9], "b": [0, -5, -5, -5, -5]}
    expected = {k: {day(i + 1): Decimal(v) for i, v in enumerate(vs)} for k, vs in expected.items()}
    expanded = ops.expand_days(ops.daily_intervals(txns, "entity", START, END, carry=ops.carry_max))
    assert as_series(expanded) == expected
    assert as_series(spine_and_fill(txns, ops.running_max)) == expected
    assert as_series(gaps_and_fill(txns, ops.running_max)) == expected


def test_null_entity_has_the_zero_series(spark):
    txns = spark.createDataFrame([txn(None, 2, 5), txn(None, 3, 6)], SCHEMA)
    expected = {None: {day(n): Decimal(0) for n in range(1, 6)}}
    assert as_series(ops.daily_balance(txns, "entity", START, END)) == expected
    assert as_series(spine_and_fill(txns)) == expected


def test_null_day_counts_for_the_entity_only(spark):
    txns = spark.createDataFrame([("a", None, None, 1, Decimal(7), None, None)], SCHEMA)
    assert as_series(ops.daily_balance(txns, "entity", START, END)) == {"a": {day(n): Decimal(0) for n in range(1, 6)}}


def test_intervals_tile_the_span(spark):
    intervals = ops.daily_intervals(ops.posted(case_txns(spark)), "entity", START, END)
    covered = {}
    for row in intervals.collect():
        days = [row.first_day + timedelta(days=i) for i in range((row.last_day - row.first_day).days + 1)]
        covered.setdefault(row.entity, []).extend(days)
    assert all(sorted(days) == [day(n) for n in range(1, 6)] for days in covered.values())


def test_months_split_without_changing_the_series(spark):
    txns = spark.createDataFrame([txn("a", 20, 3), txn("a", 70, 5), txn("b", -40, 9)], SCHEMA)
    start, end = date(2023, 12, 15), date(2024, 4, 2)
    intervals = ops.daily_intervals(txns, "entity", start, end)
    pieces = ops.split_months(intervals)
    whole = rows(ops.expand_days(intervals))
    split = ops.expand_days(pieces)
    assert rows(split.drop("month")) == whole
    assert all((r.month.year, r.month.month) == (r.date.year, r.date.month) for r in split.collect())


def test_spine_rows(spark):
    entities = spark.createDataFrame([("a",), ("b",)], "entity string")
    assert rows(ops.entity_spine(entities, START, END)) == [(e, day(n)) for e in "ab" for n in range(1, 6)]


TXNS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.integers(-2, 9),
        st.none() | st.integers(-500, 500),
        st.none() | st.integers(0, 3),
        st.integers(0, 2),
        st.sampled_from([None, None, "PENDING"]),
    ),
    min_size=1,
    max_size=40,
)


def brute_force(txns):
    """The balance rules, day by day over plain tuples."""
    counted = [t for t in txns if t[5] is None]
    result = {}
    for entity in {t[0] for t in counted}:
        result[entity], held = {}, Decimal(0)
        for n in range(1, 6):
            of_day = [t for t in counted if entity is not None and t[0] == entity and t[1] == day(n)]
            if of_day:
                oldest = (datetime.min, -1, Decimal("-1e9"))
                latest = max(of_day, key=lambda t: tuple(o if v is None else v for v, o in zip(t[2:5], oldest)))
                held = held if latest[4] is None else latest[4]
            result[entity][day(n)] = held
    return result


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(drawn=TXNS)
def test_formulations_equal_brute_force(spark, drawn):
    txns = [txn(*t) for t in drawn]
    frame = ops.posted(spark.createDataFrame(txns, SCHEMA))
    expected = brute_force(txns)
    assert all(as_series(formulation(frame)) == expected for formulation in FORMULATIONS.values())


def test_fill_does_not_shuffle_days(spark):
    txns = ops.posted(case_txns(spark))
    assert physical_plan(gaps_and_fill(txns)).count("Exchange hashpartitioning") == 2


def test_plan_expands_after_the_last_shuffle(spark, data):
    from daybook.catalogue import catalogue

    plan = physical_plan(catalogue()["fact_balance_loan"](spark, data))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan
    assert plan.index("Generate") < plan.index("Join") < plan.index("Exchange hashpartitioning(loan_id")
    assert plan.count("Generate") == 1
