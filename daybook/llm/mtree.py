"""Exact highest inner products by best-first search of an M-tree.

A node has a routing object, the radius that covers all below it, and its children's distances from the routing object.
By the triangle inequality no inner product below a node exceeds ``q.c + |q| r``; with the distance from the parent's
routing object p, ``q.c <= q.p + |q| d(c, p)``, so a child whose bound from stored numbers alone is too low is dropped
without computing its product. The nodes under the root are cells, spread over the cluster.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import neighbours
from daybook.llm.common import kept
from daybook.llm.neighbours import MOST_CELLS, PART_ROWS, matrix

K = 5
SCALE = 256
PAGE = 256
FAN = 16
SEED = 3
#: What rounding may take from a bound, as a share of the norms in it.
SLACK = 1e-9


@dataclass
class Node:
    """A page of rows, or routing objects with their covering radii and subtrees; ``apart``: the distances of the rows
    or routing objects from this node's own routing object."""

    apart: np.ndarray
    rows: np.ndarray
    centers: np.ndarray | None = None
    radii: np.ndarray | None = None
    children: list[Node] = field(default_factory=list)
    first: int = 0


def distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = v - c
    return np.sqrt((d * d).sum(axis=-1))


def built(v: np.ndarray, rows: np.ndarray, center: np.ndarray, draw) -> Node:
    """The subtree of these rows of ``v`` under the routing object ``center``."""
    if len(rows) <= PAGE:
        return Node(distances(v[rows], center), rows)
    fan = min(FAN, max(2, -(-3 * len(rows) // (2 * PAGE))))  # few rows make few pages, filled well
    chosen = rows[np.sort(draw.choice(len(rows), fan, replace=False))]
    to = np.stack([distances(v[rows], v[c]) for c in chosen], axis=1)
    group = to.argmin(axis=1)
    own = [rows[group == i] for i in range(fan)]
    if max(map(len, own)) == len(rows):  # all nearest to one: pages are cut as rows come
        own = np.array_split(rows, fan)
    some = [i for i in range(fan) if len(own[i])]
    children = [built(v, own[i], v[chosen[i]], draw) for i in some]
    centers = v[chosen[some]]
    radii = np.array([distances(v[own[i]], v[chosen[i]]).max() for i in some])
    return Node(distances(centers, center), chosen[some], centers, radii, children)


class MTree:
    def __init__(self, vectors: np.ndarray):
        """``vectors``: whole numbers, in the order in which equal scores rank."""
        v = vectors.astype(np.float64)
        self.center = v.mean(axis=0)
        self.root = built(v, np.arange(len(vectors)), self.center, np.random.default_rng(SEED))
        self.largest = float(np.abs(v).max(initial=0))
        # Pages lie one after the other, so that one is read without gathering its rows.
        pages, todo = [], [self.root]
        while todo:
            node = todo.pop()
            todo += node.children
            if node.radii is None:
                node.first = sum(len(p.rows) for p in pages[-1:]) + (pages[-1].first if pages else 0)
                pages.append(node)
        order = np.concatenate([p.rows for p in pages])
        # Products of whole numbers are exact as floats below 2 ** 53, in any order of summation.
        self.exact = self.largest**2 * vectors.shape[1] < 2**53
        self.pages = v[order] if self.exact else vectors[order]

    def highest(self, q: np.ndarray, k: int, seen: int | None) -> list[tuple[int, int]]:
        """(score, row) of the ``k`` highest scores, lower rows first among equals; nothing below ``seen``."""
        asked, q = q, q.astype(np.float64)
        asked = q if self.exact and float(np.abs(q).max(initial=0)) <= self.largest else asked
        norm = float(np.sqrt(q @ q))
        kth, found, turn = -np.inf if seen is None else seen, [], 0
        slack = SLACK * (1 + norm) * (1 + self.largest * len(q))
        heap = [(-np.inf, 0, self.root, float(q @ self.center))]
        while heap:
            bound, _, node, at_center = heapq.heappop(heap)
            if -bound < kth:
                break
            # From stored distances alone, before any product is computed.
            reach = node.apart if node.radii is None else node.apart + node.radii
            near = np.flatnonzero(reach >= (kth - slack - at_center) / norm) if norm else np.arange(len(reach))
            if node.radii is None:
                page = self.pages[node.first : node.first + len(node.rows)]
                scores = (page if len(near) == len(page) else page[near]) @ asked
                if len(scores) and scores.max() >= kth:
                    good = np.flatnonzero(scores >= kth)
                    found += zip(map(int, scores[good].tolist()), node.rows[near[good]].tolist(), strict=True)
                    found.sort(key=lambda x: (-x[0], x[1]))
                    del found[k:]
                    if len(found) == k:
                        kth = max(kth, found[-1][0])
                continue
            products = node.centers[near] @ q
            bounds = products + norm * node.radii[near] + slack
            for i in np.flatnonzero(bounds >= kth).tolist():
                turn += 1
                heapq.heappush(heap, (-float(bounds[i]), turn, node.children[near[i]], float(products[i])))
        return found


FOUND = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("score", pa.int64())])


def highest_products(rows: DataFrame, queries: Column | None = None, k: int = K, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score) from ``rows`` (vec_id, embedding): each query's ``k`` highest inner products.

    Components are taken as floor(scale * x). ``queries`` says which rows ask, those with an id divisible by 50 by
    default; every other id is a candidate. Equal scores rank by id. Vectors that are null, or hold a null or a
    component that is not finite, take no part, nor do rows without an id or vectors of another length than the commonest. Repeated
    rows count once. Other columns are not read. A score is a long: a vector of n components, one of which is beyond
    sqrt(2 ** 63 / n), is an error, as its products may not fit.
    """
    spark = rows.sparkSession
    most = F.sqrt(F.lit(2.0**63) / F.size("embedding"))
    beyond = F.raise_error("a component is too large for scores in 64 bits")

    def whole(c: Column) -> Column:
        return F.when(F.abs(c * scale) + 1 < most, F.floor(c * scale)).otherwise(beyond).cast("long")

    vectors = neighbours.usable(rows, whole, zero=True)
    classes = neighbours.distinct(vectors)
    asking = kept(vectors.filter(F.col("id") % 50 == 0 if queries is None else queries), "queries")
    drawn, n = neighbours.sample(classes)
    schema = "query long, class long, score long"
    if not n:
        return neighbours.ranked(spark.createDataFrame([], schema), vectors, classes, asking, k)
    wanted = min(MOST_CELLS, len(drawn), -(-n // PART_ROWS))
    pivots = drawn[np.sort(np.random.default_rng(SEED).choice(len(drawn), wanted, replace=False))].astype(np.float64)
    shared = spark.sparkContext.broadcast(pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch["v"]).astype(np.float64)
            least, cell = np.full(len(v), np.inf), np.zeros(len(v), dtype=np.int32)
            for number, pivot in enumerate(shared.value if len(v) else ()):
                d = distances(v, pivot)
                nearer = d < least
                least[nearer], cell[nearer] = d[nearer], number
            yield pa.RecordBatch.from_arrays(
                [batch["class"], batch["v"], pa.array(cell), pa.array(least)], ["class", "v", "cell", "apart"]
            )

    celled = kept(classes.mapInArrow(place, "class long, v array<long>, cell int, apart double"), "cells")
    held, parts = neighbours.parted(celled.select("cell", "class", "v"))
    own = asking.join(classes, "v").select(F.col("class").alias("query")).distinct()
    asks = kept(own.join(celled, own["query"] == celled["class"]).select("cell", "query", "v"), "asks")

    def search(key: tuple, asked: pa.Table, stored: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(stored):
            order = np.argsort(np.asarray(stored["class"]))
            ids, tree = np.asarray(stored["class"])[order], MTree(matrix(stored["v"])[order])
            for query, q, seen in zip(asked["query"].to_pylist(), matrix(asked["v"]), asked["seen"].to_pylist(), strict=True):
                out += [(query, int(ids[i]), score) for score, i in tree.highest(q, k + 1, seen)]
        return pa.Table.from_pylist([dict(zip(FOUND.names, row, strict=True)) for row in out], FOUND)

    # A row for each cell.
    radii = {r.cell: r.radius for r in celled.groupBy("cell").agg(F.max("apart").alias("radius")).collect()}

    def highest_cells(batch: pa.RecordBatch) -> list[np.ndarray]:
        numbers = np.array(sorted(radii), dtype=np.int32)
        centers, radius = shared.value[numbers], np.array([radii[i] for i in numbers])
        out = []
        for own, q, seen in zip(
            batch["cell"].to_pylist(), matrix(batch["v"]).astype(np.float64), batch["seen"].to_pylist(), strict=True
        ):
            most = (centers @ q + np.sqrt(q @ q) * radius) * (1 + SLACK) + SLACK
            most = most + SLACK * np.abs(most)
            near = np.argsort(-most, kind="stable")
            near = near if seen is None else near[most[near] >= seen]
            out.append(numbers[near][numbers[near] != own])
        return out

    found = neighbours.search_cells(held, parts, asks, search, highest_cells, schema, k + 1)
    return neighbours.ranked(found, vectors, classes, asking, k)
