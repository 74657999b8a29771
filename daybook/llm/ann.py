"""Approximate nearest neighbours by stable projections in a kd-tree.

Unit vectors are projected to a few dimensions by a Gaussian matrix: the squared projected distance of two points over
their squared distance follows a chi-square distribution. A kd-tree over the projections, its upper levels
distributed as cells, yields points by growing projected distance. Each is verified on the original vectors, until a point nearer than
the k-th best so far would, with probability CONFIDENCE, have come already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm import neighbours
from daybook.llm.common import kept
from daybook.llm.neighbours import MOST_CELLS, PART_ROWS, matrix

K = 5
#: Even, for the closed form of the distribution.
DIMENSIONS = 8
CONFIDENCE = 0.97
SEED = 5
LEAF = 128
#: Leaves that a search verifies between two stopping tests.
STRIDE = 4


def chi_square(x: float, dimensions: int = DIMENSIONS) -> float:
    """Distribution function for an even number of dimensions."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half**i / math.factorial(i) for i in range(dimensions // 2))


def quantile(p: float, dimensions: int = DIMENSIONS) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dimensions) < p else (low, middle)
    return high


def projection(length: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(length, DIMENSIONS))


def unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def cosines(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``q`` in double precision; the same whatever other rows there are."""
    v, q = v / np.abs(v).max(axis=1, keepdims=True), q / np.abs(q).max()
    return (v * q).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * math.sqrt((q * q).sum()))


def split(points: np.ndarray, at: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, list]]:
    """Leaves of a kd-tree as (points, path); a path has (dimension, value, whether above) from the root down."""
    todo = [(at, [])]
    while todo:
        own, path = todo.pop()
        if len(own) <= size:
            yield own, path
            continue
        spread = np.ptp(points[own], axis=0)
        d = int(spread.argmax())
        own = own[np.argsort(points[own, d], kind="stable")]
        value = points[own[len(own) // 2], d]
        low = points[own, d] < value
        if not low.any():  # as many points as half share their value
            yield own, path
            continue
        todo.append((own[~low], [*path, (d, value, True)]))
        todo.append((own[low], [*path, (d, value, False)]))


class KdTree:
    """A kd-tree over projected points, for one part of a cell."""

    def __init__(self, projected: np.ndarray):
        self.leaves = [own for own, _ in split(projected, np.arange(len(projected)), LEAF)]
        self.low = np.array([projected[own].min(axis=0) for own in self.leaves])
        self.high = np.array([projected[own].max(axis=0) for own in self.leaves])
        self.projected = projected

    def by_distance(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """(squared distance of the nearest leaf still to come, points of some leaves), nearest leaves first."""
        far = box_distances(self.low, self.high, q)
        order = np.argsort(far)
        for i in range(0, len(order), STRIDE):
            own = np.concatenate([self.leaves[leaf] for leaf in order[i : i + STRIDE]])
            yield float(far[order[i]]), own


def box_distances(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    out = np.maximum(0, np.maximum(low - q, q - high))
    return (out * out).sum(axis=1)


def nearest(tree: KdTree, vectors: np.ndarray, units: np.ndarray, q: np.ndarray, seen: float, k: int) -> list[tuple[float, int]]:
    """(cosine, row) of the ``k`` best found. ``seen``: the k-th best cosine that the query has elsewhere, or -1."""
    q_unit = unit(q[None])[0]
    q_projected = q_unit @ projection(len(q))
    enough, found, kth = quantile(CONFIDENCE), [], seen
    for far, own in tree.by_distance(q_projected):
        # The test: a point within the k-th distance is projected nearer than this with probability CONFIDENCE.
        reach = enough * max(0.0, 2 - 2 * kth)
        if far > reach + 1e-9:
            break
        apart = tree.projected[own] - q_projected
        own = own[(apart * apart).sum(axis=1) <= reach + 1e-9]
        about = units[own] @ q_unit
        own = own[about >= kth - 1e-9]
        found += zip(cosines(vectors[own], q).tolist(), own.tolist(), strict=True)
        found.sort(key=lambda x: (-x[0], x[1]))
        del found[k:]
        if len(found) == k:
            kth = max(kth, found[-1][0])
    return found


def cells(drawn: np.ndarray, n: int) -> list[list]:
    """Paths of the upper levels, from a sample's projections: about a cell per PART_ROWS rows, MOST_CELLS at most."""
    wanted = min(MOST_CELLS, max(1, -(-n // PART_ROWS)))
    projected = unit(drawn) @ projection(drawn.shape[1])
    return [path for _, path in split(projected, np.arange(len(drawn)), max(1, -(-len(drawn) // wanted)))]


def cell_of(projected: np.ndarray, paths: list[list]) -> np.ndarray:
    """The cell of each point: all points go down the upper levels together, two groups at a node."""
    out = np.zeros(len(projected), dtype=np.int32)
    todo = [(np.arange(len(projected)), list(range(len(paths))), 0)]
    while todo:
        own, below, depth = todo.pop()
        if len(below) == 1:
            out[own] = below[0]
        elif len(own):
            d, value, _ = paths[below[0]][depth]
            high = projected[own, d] >= value
            for above in (False, True):
                todo.append((own[high == above], [c for c in below if paths[c][depth][2] == above], depth + 1))
    return out


def nearest_neighbours(rows: DataFrame, queries: Column | None = None, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) from ``rows`` (vec_id, embedding): the ``k`` nearest found of each query by cosine.

    ``queries`` says which rows ask, those with an id divisible by 50 by default; every other id is a candidate.
    Vectors that are null, zero, or hold a null or a component that is not finite take no part, nor do rows without an
    id or vectors of another length than the commonest. Repeated rows count once. Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = neighbours.usable(rows, lambda c: c, zero=False)
    classes = neighbours.distinct(vectors)
    asking = kept(vectors.filter(F.col("id") % 50 == 0 if queries is None else queries), "queries")
    drawn, n = neighbours.sample(classes)
    if not n:
        return neighbours.ranked(
            spark.createDataFrame([], "query long, class long, score double"), vectors, classes, asking, k
        )
    shared = spark.sparkContext.broadcast((cells(drawn, n), projection(drawn.shape[1])))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths, onto = shared.value
        for batch in batches:
            projected = unit(matrix(batch["v"])) @ onto if len(batch) else np.zeros((0, DIMENSIONS))
            yield pa.RecordBatch.from_arrays(
                [batch["class"], batch["v"], pa.array(cell_of(projected, paths)), pa.array(list(projected), pa.list_(pa.float64()))],
                ["class", "v", "cell", "y"],
            )

    celled = kept(classes.mapInArrow(place, "class long, v array<double>, cell int, y array<double>"), "cells")
    held, parts = neighbours.parted(celled.select("cell", "class", "v"))
    own = asking.join(classes, "v").select(F.col("class").alias("query")).distinct()
    asks = kept(own.join(celled, own["query"] == celled["class"]).select("cell", "query", "v", "y"), "asks")

    def search(key: tuple, asked: pa.Table, stored: pa.Table) -> pa.Table:
        out = []
        if len(asked) and len(stored):
            order = np.argsort(np.asarray(stored["class"]))
            ids, v = np.asarray(stored["class"])[order], matrix(stored["v"])[order]
            units = unit(v)
            tree = KdTree(units @ projection(v.shape[1]))
            for query, q, seen in zip(asked["query"].to_pylist(), matrix(asked["v"]), asked["seen"].to_pylist(), strict=True):
                bound = -1.0 if seen is None else seen
                out += [(query, int(ids[i]), score) for score, i in nearest(tree, v, units, q, bound, k + 1)]
        return pa.Table.from_pylist([dict(zip(("query", "class", "score"), row, strict=True)) for row in out], FOUND)

    each = [f(F.col("y")[d]).alias(f"{f.__name__}{d}") for f in (F.min, F.max) for d in range(DIMENSIONS)]
    # A row for each cell.
    boxes = celled.groupBy("cell").agg(*each).orderBy("cell").collect()
    box = spark.sparkContext.broadcast((np.array([b[0] for b in boxes]), np.array([b[1:] for b in boxes], dtype=float)))

    def nearest_cells(batch: pa.RecordBatch) -> list[np.ndarray]:
        numbers, sides = box.value
        low, high, enough = sides[:, :DIMENSIONS], sides[:, DIMENSIONS:], quantile(CONFIDENCE)
        out = []
        for own, y, seen in zip(*(batch[c].to_pylist() for c in ("cell", "y", "seen")), strict=True):
            far = box_distances(low, high, np.array(y))
            near = np.argsort(far, kind="stable")
            near = near[far[near] <= enough * max(0.0, 2 - 2 * (-1.0 if seen is None else seen)) + 1e-9]
            out.append(numbers[near][numbers[near] != own])
        return out

    schema = "query long, class long, score double"
    found = neighbours.search_cells(held, parts, asks, search, nearest_cells, schema, k + 1)
    return neighbours.ranked(found, vectors, classes, asking, k)


FOUND = pa.schema([("query", pa.int64()), ("class", pa.int64()), ("score", pa.float64())])
