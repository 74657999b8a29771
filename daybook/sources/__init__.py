"""Where rows come from: tables, replication rules, date series, object listings."""

from daybook.sources.bank import bank_tables
from daybook.sources.inventory import inventory, inventory_summary
from daybook.sources.rules import Include, apply_rules, parse_rules
from daybook.sources.schemas import SOURCE_SCHEMAS
from daybook.sources.series import calendar, date_spine, observed_spine
from daybook.sources.tables import TableSet, require_schema

__all__ = [
    "Include",
    "SOURCE_SCHEMAS",
    "TableSet",
    "apply_rules",
    "bank_tables",
    "calendar",
    "date_spine",
    "inventory",
    "inventory_summary",
    "observed_spine",
    "parse_rules",
    "require_schema",
]
