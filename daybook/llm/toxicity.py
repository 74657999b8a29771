"""Toxicity of texts: subword-bag embeddings averaged into a linear softmax.

A word's subwords are itself and its character n-grams, with its borders marked, hashed into a table of vectors. The
mean of the vectors of all subwords of a text goes through a linear softmax; both are trained jointly. A misspelling that was never
seen shares n-grams, and so vectors, with the word it comes from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from daybook.llm.common import held_out, labelled_sample, slices, sums, words_of

FOLDS, OUT = 5, 0
#: Labelled ids that the model is fitted on, about, with a text each: the bound of what one task reads.
SAMPLE = 6000
BITS = 17
SIZE = 8
GRAMS = (3, 4, 5)
PASSES = 8
RATE = 0.3
#: Squared steps that every vector begins with: subwords of few texts move little, but all of them move.
FIRST_SEEN = 1e-2
#: Toxic rows weigh as much as clean ones in all, one row this many times as much at most.
MOST_WEIGHT = 10.0
#: Pull of the vectors towards zero, per step and unit.
DECAY = 1e-3
SEED = 7
#: Means are of many subwords, so small; the softmax sees them scaled by this.
SCALE = 20.0

_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(places in the table of all words' subwords in turn, number of each word's): the word and its n-grams."""
    marked = [f"<{w.strip(_SIGNS)}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.repeat(np.cumsum(sizes), sizes)
    here = np.arange(len(ends))
    of_word = np.repeat(np.arange(len(sizes)), sizes)
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4")
    whole = np.fromiter((zlib.crc32(m.encode("utf-8", "surrogatepass")) for m in marked), np.uint32, len(marked))
    found, owners = [whole], [np.arange(len(sizes))]
    for n in GRAMS:
        fits = np.flatnonzero(here + n <= ends)
        h = np.full(len(fits), n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ letters[fits + i]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        found.append(h * np.uint32(0x85EBCA6B))
        owners.append(of_word[fits])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    places = (np.concatenate(found) >> np.uint32(32 - BITS)).astype(np.int64)
    return places[order], np.bincount(owner, minlength=len(sizes))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """(contribution of each place, bias) of the difference of the two classes. rows: (places, shares, label)."""
    draw = np.random.default_rng(SEED)
    vectors, seen = np.zeros((1 << BITS, SIZE), dtype=np.float32), np.full((1 << BITS, 1), FIRST_SEEN, dtype=np.float32)
    softmax = draw.normal(size=(2, SIZE)).astype(np.float32)
    bias, softmax_seen = np.zeros(2), np.full((2, SIZE), 1e-2)
    toxic = sum(label for _, _, label in rows)
    weight = (1.0, min(MOST_WEIGHT, (len(rows) - toxic) / max(1, toxic)) or 1.0)
    for turn in range(passes):
        rate = RATE * (1 - turn / passes)
        for i in draw.permutation(len(rows)):
            places, share, label = rows[i]
            own = vectors[places]
            mean = share @ own * SCALE
            logit = softmax @ mean + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label] -= 1
            p *= weight[label]
            to_mean = p @ softmax
            g = share[:, None] * SCALE * to_mean[None, :] + DECAY * own
            seen[places] += (g * g).mean(axis=1, keepdims=True)
            vectors[places] = own - rate * g / np.sqrt(seen[places])
            step = np.outer(p, mean)
            softmax_seen += step * step
            softmax -= (rate * 0.1 * step / np.sqrt(softmax_seen)).astype(np.float32)
            bias -= rate * 0.1 * p
    return vectors @ (softmax[1] - softmax[0]) * SCALE, float(bias[1] - bias[0])


def training_rows(texts: pa.Array, labels: list[int]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    rows, at = [], 0
    for part in slices(texts):
        words, codes, lengths = words_of(part)
        flat, sizes = subwords(words)
        by_word = np.split(flat, np.cumsum(sizes)[:-1])
        for own in np.split(codes, np.cumsum(lengths)[:-1]):
            word, count = np.unique(own, return_counts=True)
            if len(word):
                weight = np.repeat(count, sizes[word])
                place, back = np.unique(np.concatenate([by_word[w] for w in word]), return_inverse=True)
                share = np.bincount(back, weight) / weight.sum()
                rows.append((place.astype(np.int32), share.astype(np.float32), labels[at]))
            at += 1
    return rows


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS, out: int = OUT) -> tuple[np.ndarray, float]:
    """(contribution of each place, bias), from about ``sample`` labelled rows outside the held-out fold."""
    drawn = labelled_sample(docs, labels, "toxic", folds, out, sample)
    one = drawn.repartition(1).sortWithinPartitions(F.xxhash64("text"), "text", "label")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += training_rows(batch["text"], batch["label"].to_pylist())
        by_place, bias = train(rows)
        at = np.flatnonzero(by_place)
        values = np.append(by_place[at].astype(np.float64), bias)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, 1 << BITS)), pa.array(values)], ["at", "value"])

    values = np.zeros((1 << BITS) + 1)
    # At most 2 ** BITS + 1 rows.
    for row in one.mapInArrow(fitted, "at long, value double").collect():
        values[row.at] = row.value
    return values[:-1], values[-1]


def scored(text: Column, by_place: np.ndarray, bias: float, spark) -> Column:
    """The score of a column of texts, 0 to 1; of an empty or null text what the bias gives."""
    shared = spark.sparkContext.broadcast(by_place)

    def of(texts: pa.Array) -> pa.Array:
        values, found = shared.value, [np.zeros(0)]
        for part in slices(texts):
            words, codes, lengths = words_of(part)
            places, sizes = subwords(words)
            by_word = sums(values[places], sizes)
            total, count = sums(by_word[codes], lengths), sums(sizes[codes], lengths)
            found.append(total / np.maximum(1, count) + bias)
        return pa.array(1 / (1 + np.exp(-np.concatenate(found))))

    return F.arrow_udf(of, DoubleType())(text)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``.

    Held out is a row whose id's crc32 is 0 modulo 5, or that has no id. Only ``text`` is an input of the score. Rows alike in text
    score alike. Without any usable label every score is 0.5.
    """
    by_place, bias = fit(docs, labels, sample)
    out = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, OUT).alias("held_out"), "text")
    out = out.withColumn("score", scored(F.col("text"), by_place, bias, docs.sparkSession))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
