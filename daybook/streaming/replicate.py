"""Resume replication: take the change files that landed since the last run into the copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from daybook.sinks.lake import read_copy, upsert_copy
from daybook.sinks.versions import is_committed
from daybook.sources.rules import Include


def replicate(
    spark: SparkSession,
    table: str,
    schema: StructType,
    landing: str,
    lake: str,
    checkpoint: str,
    rules: Sequence[Include],
    order: Sequence[str],
    key: str = "id",
    files_per_batch: int = 1000,
) -> StreamingQuery | None:
    """Start reading ``<landing>/<table>`` into ``<lake>/<table>``, as far as a rule selects the table.

    Takes what has landed and ends; the next call goes on from there. A batch is one version of the
    copy, named by the query's id, which its checkpoint keeps, and the batch's number: a batch that runs again after
    a failure is taken once, and a new checkpoint starts labels of its own.

    The copy holds the newest version of every key, whatever the rules' row filters say: a row that no longer passes
    them must replace the one that did. :func:`selected` filters on reading.
    """
    fitting = [rule for rule in rules if rule.fits(table)]
    if not fitting:
        return None
    changes = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{landing}/{table}")
    )

    def apply(batch: DataFrame, number: int) -> None:
        spark, root = batch.sparkSession, f"{lake}/{table}"
        label = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        if not is_committed(spark, root, label):
            upsert_copy(spark, batch, root, label, key, order)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", f"{checkpoint}/{table}")
        .trigger(availableNow=True)
        .start()
    )


def selected(spark: SparkSession, table: str, lake: str, rules: Sequence[Include]) -> DataFrame:
    """The rows of a copy that the rules' row filters keep."""
    rows = read_copy(spark, f"{lake}/{table}")
    for rule in rules:
        if rule.fits(table):
            rows = rule.keep(rows)
    return rows
