"""What the warehouse holds: target tables, their builders, and the audit of both."""

from daybook.plans.dimensions import DEPOSITS, LOANS, Ledger, Run
from daybook.plans.facts import Span
from daybook.plans.targets import SUMMARIES, TARGETS, Target, conform
from daybook.plans.warehouse import audit_constraints, build_warehouse, interval_violations, violations

__all__ = [
    "DEPOSITS",
    "LOANS",
    "Ledger",
    "Run",
    "Span",
    "SUMMARIES",
    "TARGETS",
    "Target",
    "audit_constraints",
    "build_warehouse",
    "conform",
    "interval_violations",
    "violations",
]
