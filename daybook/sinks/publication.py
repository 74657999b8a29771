"""Publish dictionary items as a data source whose tasks report what they put and whose driver side commits or aborts.

Items replace those of the same id, so a task that runs again, or a publication that is repeated, does no harm. What a
publication holds is told by one more item, its record, which is put after all tasks have succeeded: counts come from the
attempts that did, so items put by a lost attempt are not counted twice. Where a task fails for good the record says so.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from daybook.sinks.items import Item, Put, to_item

COMMITTED, ABORTED = "committed", "aborted"
COLUMNS = ("id", "source_id", "source_table", "attributes")


@dataclass
class Sent(WriterCommitMessage):
    """What one task has put: items per source table."""

    items: dict[str, int]


def record_id(label: str) -> str:
    return f"publication/{label}"


class ItemWriter(DataSourceWriter):
    def __init__(self, connect: Callable[[], Put], label: str, batch_size: int):
        self.connect, self.label, self.batch_size = connect, label, batch_size

    def write(self, iterator: Iterator[Row]) -> Sent:
        put, sent = self.connect(), Counter()
        for rows in batched(iterator, self.batch_size):
            put([to_item(row) for row in rows])
            sent.update(row.source_table for row in rows)
        return Sent(dict(sent))

    def commit(self, messages: list[Sent | None]) -> None:
        total: Counter = Counter()
        for message in messages:
            total.update(message.items if message else {})
        self.connect()([self._record(COMMITTED, dict(total))])

    def abort(self, messages: list[Sent | None]) -> None:
        self.connect()([self._record(ABORTED, {})])

    def _record(self, state: str, items: dict[str, int]) -> Item:
        return {"id": record_id(self.label), "source_id": self.label, "source_table": "publication", "state": state, "items": items}


def publish(items: DataFrame, connect: Callable[[], Put], label: str, batch_size: int = 25) -> None:
    """Send items (:func:`daybook.operators.dictionary_items`) and put the record of ``label``: committed, with the number of
    items of each table, or aborted, and then the error is raised.

    ``connect`` gives the put call; it runs once per task and once to commit or abort. No items give a record without tables.
    """
    name = "dictionary_items"

    class Items(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return ItemWriter(connect, label, batch_size)

    items.sparkSession.dataSource.register(Items)
    items.select(*COLUMNS).write.format(name).mode("append").save()
