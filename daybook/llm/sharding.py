"""Placement of documents on shards by a lookup table that permutations fill.

Each shard prefers the slots of a prime-sized table in an order of its own, ``offset + j * skip``. Shards take
turns; each claims the first slot in its order that is still free, until the table is full. A document's hash names
its slot and so its shard in constant time. Adding or removing a shard moves little else than that shard's share.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 128
#: Prime, and over a hundred slots a shard, which holds the shares of shards within a percent of each other.
SLOTS = 16_381
#: Hexadecimal digits of the key's MD5 that name the slot: 60 bits, which fit a long.
DIGITS = 15
#: Bytes of text that a file of a shard should hold, and partitions at most that files are written from.
PIECE_BYTES = 256 << 20
MOST_TASKS = 100_000


def preference(shard: str, slots: int) -> tuple[int, int]:
    """(offset, skip) of a shard's order over the slots."""
    digest = hashlib.md5(shard.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def filled_table(shards: list[str], slots: int) -> list[int]:
    """The shard (by its place in ``shards``) of each slot. Of bounded size: it depends on no data."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, one at least")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime and no less than the shards; {slots} is not")
    orders = [preference(s, slots) for s in shards]
    step, table, free = [0] * len(shards), [-1] * slots, slots
    while True:
        for i, (offset, skip) in enumerate(orders):
            while table[slot := (offset + step[i] * skip) % slots] >= 0:
                step[i] += 1
            table[slot] = i
            free -= 1
            if not free:
                return table


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def lookup(spark: SparkSession, shards: list[str], slots: int) -> DataFrame:
    """(slot, shard): ``slots`` rows, whatever the data."""
    table = filled_table(shards, slots)
    return spark.createDataFrame([(slot, i) for slot, i in enumerate(table)], "slot long, shard int")


def slot_of(key: Column, slots: int) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, DIGITS), 16, 10).cast("long") % slots


def place(docs: DataFrame, shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """(doc_id, slot, shard) of each row of ``docs``, by the hash of its id.

    Every row is placed, repeated rows alike. Rows without an id are spread by their text instead; those
    without a text either share one slot. Other columns are not read. The table that is broadcast has ``slots`` rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("text"))), F.lit(""))
    keyed = docs.select(F.col("doc_id"), slot_of(key, slots).alias("slot"))
    return keyed.join(F.broadcast(lookup(docs.sparkSession, shards or shard_names(), slots)), "slot").select(
        "doc_id", "slot", "shard"
    )


def write_shards(
    docs: DataFrame, path: str, shards: list[str] | None = None, slots: int = SLOTS, pieces: int | None = None
) -> None:
    """Write ``docs`` as one folder a shard, each in up to ``pieces`` files. The folders are named ``__shard=<number>``.

    Without ``pieces`` there are as many as make files of about PIECE_BYTES of text; a task writes one. Rows go to a piece
    by id and text, so only rows that are alike in both stay together. An empty table gives no folders.
    """
    names = shards or shard_names()
    if pieces is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")).first().bytes or 0
        pieces = max(1, -(-size // (PIECE_BYTES * len(names))))
    key = F.coalesce(F.col("row.doc_id").cast("string"), F.concat(F.lit("text "), F.md5(F.col("row.text"))), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"))
    placed = rows.withColumn("slot", slot_of(key, slots)).join(
        F.broadcast(lookup(docs.sparkSession, names, slots)), "slot"
    )
    piece = F.pmod(F.xxhash64("row.doc_id", "row.text"), F.lit(pieces))
    # As many partitions as files, so that no task writes several large ones.
    spread = placed.withColumn("piece", piece).repartition(min(len(names) * pieces, MOST_TASKS), "shard", "piece")
    spread.select("row.*", F.col("shard").alias("__shard")).write.partitionBy("__shard").parquet(path)
