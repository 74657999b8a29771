"""Extendible hashing: a directory of buckets that split one at a time.

A bucket holds the rows whose key hash ends in certain bits; its id is those bits with a 1 before them. A bucket
that outgrows its target is replaced by those of one bit more, or of as many as it takes; no other bucket moves. The
directory has a number of bytes for each bucket, so it grows with the table's bytes over the target.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.inventory import inventory

BUCKET = "__bucket"
#: Bytes of a bucket that one task writes: the writer sorts its rows, which take some ten times that in memory.
TASK_BYTES = 16 << 20


def key_hash(*key: str) -> Column:
    # As text, so that a key keeps its bucket when its type is widened.
    return F.xxhash64(*(F.col(c).cast("string") for c in key))


@dataclass(frozen=True)
class Directory:
    """Bytes by bucket. The buckets cover every hash, and no hash falls in two."""

    sizes: Mapping[int, int]

    @classmethod
    def of_bytes(cls, expected: int, target: int) -> Directory:
        """Enough buckets for a first load."""
        return cls({1: 0}).split({1: expected}, target)

    def bucket(self, *key: str) -> Column:
        """The id of a row's bucket."""
        by_depth = defaultdict(list)
        for b in sorted(self.sizes):
            by_depth[b.bit_length() - 1].append(b)
        h = key_hash(*key)
        ids = []
        for depth, buckets in by_depth.items():
            this = F.pmod(h, F.lit(1 << depth)) + F.lit(1 << depth)
            ids.append(F.when(this.isin(buckets), this))
        return F.coalesce(*ids).cast("int")

    def split(self, expected: Mapping[int, int], target: int) -> Directory:
        """The directory after those of the given buckets that would be over the target have been replaced."""
        sizes = dict(self.sizes)
        for b, size in expected.items():
            if size > target:
                del sizes[b]
                depth, bits = b.bit_length() - 1, math.ceil(math.log2(size / target))
                low = b - (1 << depth)
                sizes |= {(1 << depth + bits) + (i << depth) + low: 0 for i in range(1 << bits)}
        return Directory(sizes)

    def below(self, old: int) -> list[int]:
        """The buckets that hold what the given one of an earlier directory held."""
        if old in self.sizes:
            return [old]
        depth = old.bit_length() - 1
        low = old - (1 << depth)
        return [b for b in self.sizes if b.bit_length() - 1 > depth and b % (1 << depth) == low]

    def expected(self, sizes: Mapping[int, int]) -> dict[int, int]:
        """About how many bytes the buckets will have that hold what those of an earlier directory held, of these sizes."""
        parts = {old: self.below(old) for old in sizes}
        return {b: size // len(parts[old]) for old, size in sizes.items() for b in parts[old]}

    def measured(self, written: Iterable[int], found: Mapping[int, int]) -> Directory:
        """With the sizes of the buckets just written."""
        return Directory({**self.sizes, **{b: found.get(b, 0) for b in written}})


def write_buckets(rows: DataFrame, directory: Directory, key: tuple[str, ...], buckets: Mapping[int, int], path: str) -> None:
    """Write rows of the given buckets, of about so many bytes, in a task for each ``TASK_BYTES`` of a bucket.

    The tasks follow the bytes. Those of a bucket share its keys by a hash of another seed, as the bits of the first are
    alike in a bucket.
    """
    spark = rows.sparkSession
    tasks = [max(1, math.ceil(buckets[b] / TASK_BYTES)) for b in sorted(buckets)]
    firsts = [sum(tasks[:i]) for i in range(len(tasks))]
    places = spark.createDataFrame(list(zip(sorted(buckets), firsts, tasks, strict=True)), f"{BUCKET} int, __first int, __tasks int")
    laid_out = rows.withColumn(BUCKET, directory.bucket(*key)).join(F.broadcast(places), BUCKET)
    nth = F.pmod(F.xxhash64(F.lit(1), *(F.col(c).cast("string") for c in key)), F.col("__tasks"))
    dealt = laid_out.repartitionById(max(1, sum(tasks)), (F.col("__first") + nth).cast("int")).drop("__first", "__tasks")
    dealt.write.mode("errorifexists").option("compression", "zstd").partitionBy(BUCKET).parquet(path)


def rows_per_bucket(rows: DataFrame, directory: Directory, key: tuple[str, ...]) -> dict[int, int]:
    """Number of rows by bucket, for the buckets that have any: one small row a bucket."""
    counted = rows.groupBy(directory.bucket(*key).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return {r.b: r.n for r in counted.collect()}


def written_sizes(spark: SparkSession, path: str, column: str = BUCKET) -> dict[str, int]:
    """Bytes written by value of a partition column under ``path``; one small row a value."""
    files = inventory(spark, path).filter(F.col("key").endswith(".parquet"))
    value = F.regexp_extract("key", f"(?:^|/){column}=([^/]*)/", 1)
    return {r.v: r.size for r in files.groupBy(value.alias("v")).agg(F.sum("size").alias("size")).collect()}
