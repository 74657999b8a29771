"""Where rows go: versioned Parquet, catalog tables, JDBC, key-value stores."""

from daybook.sinks.dailyfact import create_fact, read_fact, refresh_fact, touched_holders
from daybook.sinks.items import publish_items
from daybook.sinks.jdbc import append_in_order
from daybook.sinks.lake import CopiesFailed, copy_tables, copy_to_catalog, create_copy, merge_copy, read_copy, read_rejected, upsert_copy
from daybook.sinks.publication import publish
from daybook.sinks.tables import publish_tables
from daybook.sinks.versions import VersionExists, commit_version, current_path, current_version, latest_commit, write_version
from daybook.sinks.warehouse import BrokenConstraints, load_warehouse, read_summaries, read_warehouse

__all__ = [
    "BrokenConstraints",
    "CopiesFailed",
    "VersionExists",
    "append_in_order",
    "commit_version",
    "copy_tables",
    "copy_to_catalog",
    "create_copy",
    "create_fact",
    "current_path",
    "current_version",
    "latest_commit",
    "load_warehouse",
    "merge_copy",
    "publish",
    "publish_items",
    "publish_tables",
    "read_copy",
    "read_fact",
    "read_rejected",
    "read_summaries",
    "read_warehouse",
    "refresh_fact",
    "touched_holders",
    "upsert_copy",
    "write_version",
]
