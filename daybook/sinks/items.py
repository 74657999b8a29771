"""Publish dictionary items to a key-value store."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from decimal import Decimal
from itertools import batched
from typing import Any

from pyspark.sql import DataFrame, Row

Item = dict[str, Any]
Put = Callable[[list[Item]], None]


def publish_items(items: DataFrame, connect: Callable[[], Put], batch_size: int = 25) -> None:
    """Send items from the executors, in batches; ``connect`` runs once per task and returns the put call.

    A put replaces the item of the same id, so a task that runs again after a loss does no harm.
    """

    def send(rows: Iterator[Row]) -> None:
        put = connect()
        for batch in batched(rows, batch_size):
            put([to_item(row) for row in batch])

    items.foreachPartition(send)


def to_item(row: Row) -> Item:
    """One flat item; numbers with a fraction are decimals of exactly the digits shown."""
    attributes = json.loads(row.attributes, parse_float=Decimal)
    return {**attributes, "id": row.id, "source_id": row.source_id, "source_table": row.source_table}
