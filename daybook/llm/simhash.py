"""Near-duplicates by SimHash and a Gray-order hierarchical index.

A fingerprint's bit is the majority of that bit over the hashes of a text's shingles. Distinct fingerprints are sorted
by Gray rank into pages. The bits that a page's fingerprints agree on stand in an upper tree, which every executor
holds; each fingerprint goes down it and on to the pages that it may have a neighbour in. A page searches those with a
tree of its own and reports what they connect, as a forest. Components of all forests are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from daybook.llm.common import kept, slices
from daybook.llm.components import components
from daybook.llm.graytree import GrayTree, forest, gray_rank

SHINGLE = 3
MOST_BITS = 2
SEED = 42
#: Fingerprints that a page should hold, and pages at least and at most. The first bound keeps the pages that a fingerprint asks
#: as many over all usual sizes, the second is that of the upper tree that is broadcast.
PAGE_ROWS = 1 << 18
LEAST_PAGES, MOST_PAGES = 64, 4096
#: Fingerprints that one task searches a page for, about.
PROBE_ROWS = 1 << 18
#: Links that a search holds before it joins what they connect. A fingerprint has 2,080 neighbours at most.
WAITING = 1 << 21

UPPER_TO_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SHIFTS = np.arange(8, dtype=np.uint8)
_BYTE_BITS = (np.arange(256)[:, None] >> _SHIFTS) & 1
_LANES = (np.arange(8) * 256)[None, :]


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(UPPER_TO_LOWER).split()
    if not words:
        return 0
    parts = [words[i:] for i in range(shingle)] if len(words) >= shingle else None
    grams = map(b" ".join, zip(*parts, strict=False)) if parts else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64)
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _LANES).ravel(), minlength=2048).reshape(8, 256)
    ones = (seen @ _BYTE_BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little", signed=True)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprints of a column of texts, as longs; null texts have no words, so zero."""

    def of(texts: pa.Array) -> pa.Array:
        found = (fingerprint(t.as_buffer().to_pybytes(), shingle) for part in slices(texts) for t in part.cast(pa.binary()))
        return pa.array(found, pa.int64())

    return F.arrow_udf(of, LongType())(text)


def gray(fp: Column) -> Column:
    """The Gray rank as a column, in an order that signed longs follow."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def joined(root: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    if not found:
        return root
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    return forest(root[a], root[b], len(root))[root]


def links(fps: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """(a, b): links that connect just those of the distinct ``fp`` that steps of ``most`` bits or fewer connect."""
    spark = fps.sparkSession
    wanted = min(MOST_PAGES, max(LEAST_PAGES, -(-fps.count() // PAGE_ROWS)))
    ranked = fps.select("fp", gray(F.col("fp")).alias("rank"))
    paged = ranked.repartitionByRange(wanted, "rank").withColumn("page", F.spark_partition_id())
    pages = kept(paged.select("page", "fp"), "pages")
    # At most MOST_PAGES rows.
    shared = pages.groupBy("page").agg(F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any"), F.count("*").alias("n"))
    roots = shared.orderBy("page").collect()
    ones, some = (np.array([r[c] for r in roots], dtype=np.int64).view(np.uint64) for c in ("ones", "any"))
    upper = spark.sparkContext.broadcast((GrayTree(ones, ~(ones ^ some)), np.array([r.page for r in roots], dtype=np.int32)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, numbers = upper.value
        for batch in batches:
            own, fp = np.asarray(batch["page"]), np.asarray(batch["fp"])
            for q, item in tree.within(fp.view(np.uint64), most):
                page = numbers[item]
                later = page >= own[q]  # of two pages one asks the other
                yield pa.RecordBatch.from_arrays([pa.array(page[later]), pa.array(fp[q[later]])], ["page", "fp"])

    probes = kept(pages.mapInArrow(route, "page int, fp long"), "probes")
    # Busy pages are searched by several tasks, each with a share of the probes.
    busy = probes.groupBy("page").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / PROBE_ROWS)).cast("int").alias("parts"))
    parts = F.broadcast(busy)
    asked = probes.join(parts, "page").select("page", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part"), "fp")
    held = pages.join(parts, "page").select("page", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "fp")

    def search(key: tuple, probe: pa.Table, page: pa.Table) -> pa.Table:
        asks, items = (np.unique(np.asarray(t["fp"]).view(np.uint64)) for t in (probe, page))
        items = items[np.argsort(gray_rank(items))]
        nodes = np.unique(np.concatenate((asks, items)))
        ask_at, item_at = np.searchsorted(nodes, asks), np.searchsorted(nodes, items)
        root, found, waiting = np.arange(len(nodes)), [], 0
        for q, item in GrayTree(items).within(asks, most):
            a, b = ask_at[q], item_at[item]
            found.append((a[a != b], b[a != b]))
            waiting += len(found[-1][0])
            if waiting > WAITING:
                root, found, waiting = joined(root, found), [], 0
        root = joined(root, found)
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        signed = nodes.view(np.int64)
        return pa.table({"a": signed[linked], "b": signed[root[linked]]})

    by = ["page", "part"]
    return asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(search, "a long, b long")


def groups(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """(doc_id, fp, component_id, root) of each row of ``docs``; rows of a group share the fingerprint ``root``.

    ``component_id`` is the smallest id that links of ``most`` differing bits or fewer reach; null where no row of the
    group has an id. Empty and null texts have fingerprint 0. Repeated rows have the same fingerprint and so the same
    group. Other columns are not read.
    """
    marked = kept(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    fps = kept(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(fps, most))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id", "root")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id", "root")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS) -> DataFrame:
    """One row of each group, with all its columns: the one with the group's smallest id.

    Where several rows have that id, the one whose text has the smallest MD5 stays; a group of rows without ids keeps
    one of them in the same way.
    """
    found = kept(groups(docs, shingle, most), "groups")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    by_id = found.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.max(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))).alias("wins")
    )
    by_id = kept(by_id.filter("wins OR n > 1 OR doc_id IS NULL"), "ids")
    own = "n = 1 AND doc_id IS NOT NULL"
    clear = rows.join(by_id.filter(f"wins AND {own}"), "doc_id", "left_semi").select("row.*")
    several = by_id.filter(f"NOT ({own})").select(F.col("doc_id").alias("id"))
    if several.isEmpty():
        return clear
    # An id of several rows, or none, does not tell which row it was: their fingerprints do.
    unclear = rows.join(several, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    marked = unclear.withColumn("fp", fingerprints(F.col("text"), shingle))
    standing = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id"), "fp", "root")
    matched = marked.join(standing.distinct(), "fp").filter(F.col("doc_id").eqNullSafe(F.col("id")))
    first = F.row_number().over(Window.partitionBy("root").orderBy(F.md5(F.col("text").cast("binary"))))
    return clear.unionByName(matched.withColumn("place", first).filter("place = 1").select("row.*"))
