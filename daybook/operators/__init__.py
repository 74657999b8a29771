"""DataFrame operators: DataFrames and parameters in, a lazy DataFrame out."""

from daybook.operators.balances import (
    active_entities,
    carry_last,
    carry_max,
    daily_balance,
    daily_intervals,
    daily_points,
    days_in_order,
    entity_spine,
    expand_days,
    forward_fill,
    in_range_order,
    latest_per_day,
    posted,
    running_max,
    series_with_gaps,
    split_months,
    tiled,
)
from daybook.operators.constraints import (
    check_foreign_key,
    check_interval_key,
    check_not_null,
    check_primary_key,
    check_unique,
    split_rejects,
)
from daybook.operators.dictionary import dictionary_attributes, dictionary_counts, dictionary_items
from daybook.operators.reconcile import reconcile, reconcile_steps
from daybook.operators.scans import forward_fill_ranges, running_max_ranges
from daybook.operators.steps import add_changes, as_steps, changes, days_in, steps_of
from daybook.operators.upsert import first_version, insert_if_absent, latest_version, split_null_keys, upsert

__all__ = [
    "active_entities",
    "add_changes",
    "as_steps",
    "carry_last",
    "carry_max",
    "changes",
    "check_foreign_key",
    "check_interval_key",
    "check_not_null",
    "check_primary_key",
    "check_unique",
    "daily_balance",
    "daily_intervals",
    "daily_points",
    "days_in",
    "days_in_order",
    "dictionary_attributes",
    "dictionary_counts",
    "dictionary_items",
    "entity_spine",
    "expand_days",
    "first_version",
    "forward_fill",
    "forward_fill_ranges",
    "in_range_order",
    "insert_if_absent",
    "latest_per_day",
    "latest_version",
    "posted",
    "reconcile",
    "reconcile_steps",
    "running_max",
    "running_max_ranges",
    "series_with_gaps",
    "split_months",
    "split_null_keys",
    "split_rejects",
    "steps_of",
    "tiled",
    "upsert",
]
