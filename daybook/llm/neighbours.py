"""What both vector searches share: usable vectors, equal vectors as one, cells searched in parts, ranks.

Equal vectors are indexed once. A cell's rows are dealt into parts of bounded size, and the queries that ask it into
slices, so that a task holds a bounded number of both however dense a cell or popular a vector is. A part is copied once
for each slice of its own cell, and stays where it is if nobody asks. A query asks its own cell first, then others in
rounds, the most promising first; every round tests with the bound that the ones before it left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import kept

#: Rows that a part of a cell should hold, cells at most, and queries that a slice should hold.
PART_ROWS = 8192
MOST_CELLS = 4096
SLICE_ROWS = 4096
#: How many cells beside its own a query may have asked after each round. The last round asks all that are left.
ROUNDS = (4, 32, 256, MOST_CELLS)
#: Rows at most, about, that an index is fitted on. All rows are indexed.
SAMPLE = 1 << 16


def usable(rows: DataFrame, value: Callable[[Column], Column], zero: bool) -> DataFrame:
    """(id, v): rows with an id and a vector of finite components, of the commonest length; all zeros only if ``zero``.

    Rows alike count once; of several vectors under one id the smallest counts.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = rows.select(F.col("vec_id").cast("long").alias("id"), x.cast("array<double>").alias("embedding"))
    good = good.filter(F.col("id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite)
    if not zero:
        good = good.filter(F.exists(x, lambda c: c != 0))
    # A row for each length: what is collected is one of them.
    length = good.groupBy(F.size(x).alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    good = good.filter(F.size(x) == (length.n if length else 0))
    one = good.groupBy("id").agg(F.min("embedding").alias("embedding"))
    return kept(one.select("id", F.transform("embedding", value).alias("v")), "vectors")


def distinct(vectors: DataFrame) -> DataFrame:
    """(class, v): each distinct vector with the smallest id that has it."""
    return kept(vectors.groupBy("v").agg(F.min("id").alias("class")).select("class", "v"), "distinct")


def sample(classes: DataFrame, most: int = SAMPLE) -> tuple[np.ndarray, int]:
    """(vectors of about ``most`` classes by the hash of their id, number of all classes)."""
    n = classes.count()
    share = min(1.0, most / max(1, n))
    drawn = classes.filter(F.pmod(F.xxhash64("class"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1))
    table = drawn.select("class", "v").toArrow().sort_by("class")
    return matrix(table["v"]), n


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), flat.dtype)


def parted(celled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their ``part``, parts of each cell): MOST_CELLS rows at most in the second."""
    parts = celled.groupBy("cell").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    parts = kept(parts, "parts")
    dealt = celled.join(F.broadcast(parts), "cell")
    return dealt.withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")).drop("parts"), parts


def searched(held: DataFrame, parts: DataFrame, asks: DataFrame, search: Callable, schema: str) -> DataFrame:
    """``search`` of each part of each cell for the slices of ``asks`` (cell, query, ...) that go there.

    ``asks`` is read twice: once to count the slices of each cell, MOST_CELLS rows at most.
    """
    busy = asks.groupBy("cell").agg(F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices"))
    busy = F.broadcast(busy.join(F.broadcast(parts), "cell"))
    asked = asks.join(busy, "cell").withColumn("slice", F.pmod(F.xxhash64("query"), F.col("slices")).cast("int"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "slices")
    copies = held.join(busy, "cell").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    by = ["cell", "part", "slice"]
    return asked.groupBy(*by).cogroup(copies.drop("parts", "slices").groupBy(*by)).applyInArrow(search, schema)


def search_cells(
    held: DataFrame, parts: DataFrame, asks: DataFrame, search: Callable, order: Callable, schema: str, k: int
) -> DataFrame:
    """The ``k`` best (query, class, score) of each query that cells left open by its bound hold.

    ``asks`` (cell, query, v, ...) has a row for each query with its own cell. ``search`` reads a further column ``seen``: the
    k-th best score so far, null where fewer are found. ``order(batch)`` gives, for each row of ``asks`` with ``seen``, the
    cells still open, most promising first and leaving out its own; a better bound only ever shortens such a list.
    """
    score = schema.rsplit(" ", 1)[1]
    vector = dict(asks.dtypes)["v"]
    cells = parts.count()

    def between(first: int, last: int) -> Callable:
        def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [near[first:last] for near in order(batch)]
                at = np.repeat(np.arange(len(own)), [len(near) for near in own])
                cell = np.concatenate(own) if own else np.zeros(0)
                taken = batch.take(pa.array(at, pa.int64()))
                columns = [pa.array(cell.astype(np.int32)), *(taken[c] for c in ("query", "v", "seen"))]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "query", "v", "seen"])

        return asking

    home = asks.select("cell", "query", "v", F.lit(None).cast(score).alias("seen"))
    found = kept(best(searched(held, parts, home, search, schema), k), "home")
    asked = 0
    for upto in ROUNDS:
        if asked >= cells - 1:
            break
        bounds = found.groupBy("query").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
        bounds = bounds.select("query", F.when(F.col("n") >= k, F.col("worst")).alias("seen"))
        further = asks.join(bounds, "query").mapInArrow(
            between(asked, upto), f"cell int, query long, v {vector}, seen {score}"
        )
        further = kept(further, "further")
        if further.isEmpty():
            break
        more = searched(held, parts, further, search, schema)
        found, asked = kept(best(found.union(more), k), "found"), upto
    return found


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (query, class, score) of each query, equal scores by class."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("class"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def ranked(found: DataFrame, vectors: DataFrame, classes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of each query, from the ``k`` + 1 best classes of its vector.

    A query's own class is among those. Of a class, the k + 1 smallest ids are all that a query can need.
    """
    named = vectors.join(classes, "v").select("id", "class")
    place = F.row_number().over(Window.partitionBy("class").orderBy("id"))
    members = named.withColumn("place", place).filter(F.col("place") <= k + 1).select("class", "id")
    asked = queries.join(classes, "v").select(F.col("id").alias("query_id"), F.col("class").alias("query"))
    near = best(found, k + 1).join(members, "class").withColumnRenamed("id", "vec_id")
    pairs = asked.join(near, "query").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    out = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
