"""Published tables as catalog tables laid out for joins: in buckets of what they are joined by, sorted.

Tables in as many buckets of the same columns are joined on those columns without an exchange. Readers go through views,
which are moved to the new tables when all are written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from daybook.plans import facts, summaries
from daybook.plans.dimensions import Run
from daybook.plans.targets import SUMMARIES
from daybook.sinks.versions import current_path, new_attempt
from daybook.sinks.warehouse import FACT, read_intervals, read_staged

#: What each table is joined by. The others are small, and are read where they were published.
JOINED_BY = {
    "dim_member": "member_id",
    "dim_account": "account_id",
    "bridge_member_account": "account_id",
    "dim_subaccount": "subaccount_id",
    FACT: "subaccount_id",
    **{name: target.key[0] for name, target in SUMMARIES.items()},
}


def publish_tables(spark: SparkSession, root: str, run: Run, database: str, buckets: int) -> dict[str, str]:
    """Lay the current version under ``root`` out in ``database``, each table in ``buckets``; returns the table behind each view.

    ``run`` is the one that the version was loaded with. Choose ``buckets`` for the days of the facts, as a task writes a bucket;
    a holder's days lie in one. Tables have new names each time, so a call that fails, or is repeated, never touches those behind
    the views. Views move one after the other, dimensions first; tables no view names are for the catalog's owner to drop.
    """
    staged = current_path(spark, root)
    attempt = re.sub(r"\W", "_", new_attempt("layout"))
    written = {}
    for name, df in _laid_out(spark, staged, run, buckets):
        by = JOINED_BY[name]
        order = [by, "date"] if "date" in df.columns else [by]
        table = f"{database}.{name}__{attempt}"
        writer = df.write.format("parquet").option("compression", "zstd")
        writer.bucketBy(buckets, by).sortBy(*order).saveAsTable(table)
        written[name] = table
    for name, table in written.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {table}")
    return written


def _laid_out(spark: SparkSession, staged: str, run: Run, buckets: int) -> Iterator[tuple[str, DataFrame]]:
    """Tables whose tasks hold one bucket each. Of the facts, intervals move, and days are spelled out in their bucket."""
    intervals = read_intervals(spark, staged)
    for name, by in JOINED_BY.items():
        if name == FACT:
            yield name, facts.fact_rows(intervals.repartition(buckets, by), run)
        elif name in SUMMARIES:
            steps = summaries.summary_intervals(name, intervals, read_staged(spark, staged, "bridge_member_account"))
            yield name, summaries.summary_rows(name, steps.repartition(buckets, by), run)
        else:
            yield name, read_staged(spark, staged, name).repartition(buckets, by)
