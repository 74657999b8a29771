"""Load a relational store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from daybook.plans.targets import TARGETS


def append_in_order(
    frames: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str],
    schema: str = "public",
    connections: int = 16,
    batch_rows: int = 10_000,
    refresh: bool = False,
    cascade: bool = False,
) -> list[str]:
    """Append the given warehouse tables so that each comes after those it refers to; returns the order.

    With ``refresh`` all of them are emptied first, in the reverse order, so that a rerun neither doubles rows nor
    breaks a reference; the tables, their keys and grants stay. A refresh needs every table that refers to a given one.
    Stores that never truncate a referenced table need ``cascade``, which empties whatever else refers to it.
    ``connections`` bounds the tasks that write at once, as every one opens a connection.
    """
    unknown = set(frames) - set(TARGETS)
    if unknown:
        raise ValueError(f"no warehouse table named {', '.join(sorted(unknown))}")
    order = [name for name in TARGETS if name in frames]
    options = {**properties, "numPartitions": str(connections), "batchsize": str(batch_rows)}
    if refresh:
        kept_out = [t.name for t in TARGETS.values() if t.name not in frames and any(r.parent in frames for r in t.references)]
        if kept_out:
            raise ValueError(f"a refresh would leave rows of {', '.join(kept_out)} without parents")
        # No rows over an existing table, truncated instead of dropped: Spark empties it in place.
        emptied = {**options, "truncate": "true", "cascadeTruncate": str(cascade).lower()}
        for name in reversed(order):
            frames[name].limit(0).write.jdbc(url=url, table=f"{schema}.{name}", mode="overwrite", properties=emptied)
    for name in order:
        frames[name].write.jdbc(url=url, table=f"{schema}.{name}", mode="append", properties=options)
    return order
