"""Replication rules: which tables to take, and which of their rows.

A rule document is JSON of the shape::

    {"rules": [{"rule-type": "selection", "rule-action": "include",
                "object-locator": {"schema-name": "public", "table-name": "%"},
                "filters": [{"filter-type": "source", "column-name": "status",
                             "filter-conditions": [{"filter-operator": "null"}]}]}]}
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Include:
    """Take the tables whose schema and name fit, keeping rows where ``null_columns`` are null.

    ``%`` stands for any text in either; case does not matter.
    """

    pattern: str
    null_columns: tuple[str, ...] = ()
    schema: str = "%"

    def fits(self, table: str, schema: str = "public") -> bool:
        return _like(self.pattern, table) and _like(self.schema, schema)

    def keep(self, df: DataFrame) -> DataFrame:
        for column in self.null_columns:
            df = df.filter(F.col(column).isNull())
        return df


def _like(pattern: str, name: str) -> bool:
    return re.fullmatch(".*".join(re.escape(piece) for piece in pattern.split("%")), name, re.IGNORECASE) is not None


def parse_rules(document: str) -> list[Include]:
    """Read a rule document; anything but an include with null filters is refused."""
    return [_include(rule) for rule in json.loads(document)["rules"]]


def _include(rule: dict) -> Include:
    if (rule.get("rule-type"), rule.get("rule-action")) != ("selection", "include"):
        raise ValueError(f"only selection rules that include are known: {rule}")
    null_columns = []
    for row_filter in rule.get("filters", ()):
        operators = [c["filter-operator"] for c in row_filter["filter-conditions"]]
        if row_filter["filter-type"] != "source" or operators != ["null"]:
            raise ValueError(f"only null filters on the source are known: {row_filter}")
        null_columns.append(row_filter["column-name"])
    locator = rule["object-locator"]
    return Include(locator["table-name"], tuple(null_columns), locator["schema-name"])


def apply_rules(tables: Mapping[str, DataFrame], rules: list[Include], schema: str = "public") -> dict[str, DataFrame]:
    """The selected tables with their row filters; ``schema`` is the one that ``tables`` were read from.

    A table named by several rules is filtered by each. A rule without wildcard must find its table.
    """
    selected: dict[str, DataFrame] = {}
    available = list(tables)
    for rule in rules:
        hits = [name for name in available if rule.fits(name, schema)]
        if not hits and "%" not in rule.pattern + rule.schema:
            raise KeyError(f"no source table named {rule.schema}.{rule.pattern}")
        for name in hits:
            selected[name] = rule.keep(selected.get(name, tables[name]))
    return selected
