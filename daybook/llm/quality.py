"""Quality of texts: logistic regression over hashed word n-grams, fitted by follow-the-regularised-leader.

A text's features are the shares of its hashed n-grams, of one or two: of its words, and of the runs that words are cut
into, of letters or digits and of signs. A word or run that repeats the one before it becomes a mark for repetition. The score
is one sparse dot product.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from daybook.llm.common import held_out, labelled_sample, slices, sums, words_of

FOLDS, OUT = 3, 1
#: Labelled ids that the model is fitted on, about, with a text each: the bound of what one task reads.
SAMPLE = 6000
BITS = 18
PASSES = 3
#: Shares are small numbers; scaled by this they suit the rate of learning.
SCALE = 20.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3

#: Runs in words that line breaks part; no word holds one.
_RUNS = re.compile(r"[^\W_]+|\n|(?:[^\w\n]|_)+")
_REPEAT = np.uint32(zlib.crc32(b"\0repeat"))
#: Words and runs that are written alike are different features.
_WORDS, _OF_RUNS = np.uint32(0x2545F491), np.uint32(0)
#: Bytes of text whose features a task works out at a time: each byte takes some twenty in arrays.
FEATURE_BYTES = 1 << 20


def runs_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words' runs in turn, number of each word's)."""
    coded = pa.array(_RUNS.findall("\n".join(words)), pa.string()).dictionary_encode()
    distinct, codes = coded.dictionary.to_pylist(), np.asarray(coded.indices, dtype=np.int64)
    hashes = np.fromiter((zlib.crc32(run.encode()) for run in distinct), np.uint32, len(distinct))
    is_break = np.array([run == "\n" for run in distinct], dtype=bool)[codes]
    of_word = np.cumsum(is_break)[~is_break]
    return hashes[codes[~is_break]], np.bincount(of_word, minlength=len(words))


def grams(flat: np.ndarray, per_text: np.ndarray, salt: np.uint32) -> np.ndarray:
    """Hashes of single items and of pairs, two for each item in turn; the first of a text pairs with its start."""
    first = np.zeros(len(flat), dtype=bool)
    first[(np.cumsum(per_text) - per_text)[per_text > 0]] = True
    again = np.zeros(len(flat), dtype=bool)
    again[1:] = flat[1:] == flat[:-1]
    single = np.where(again & ~first, _REPEAT, flat)
    pair = np.zeros_like(single)
    pair[1:] = single[:-1] * np.uint32(0x9E3779B1) ^ single[1:]
    pair[first] = single[first] ^ np.uint32(0x85EBCA6B)
    return np.column_stack(((single ^ salt) * np.uint32(0x27D4EB2F), (pair ^ salt) * np.uint32(0xC2B2AE35))).ravel()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashed features of all texts in turn, number of each text's): a text's words before its runs."""
    words, codes, n_words = words_of(texts)
    whole = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words))[codes]
    hashes, sizes = runs_of(words)
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[codes] if len(codes) else np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    runs = hashes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[codes] - (ends - lengths), lengths)]
    n_runs = sums(lengths, n_words)
    per_text = 2 * (n_words + n_runs)
    out = np.empty(int(per_text.sum()), dtype=np.uint32)
    is_word = np.repeat(np.tile([True, False], len(per_text)), np.column_stack((2 * n_words, 2 * n_runs)).ravel())
    out[is_word], out[~is_word] = grams(whole, n_words, _WORDS), grams(runs, n_runs, _OF_RUNS)
    return (out >> np.uint32(32 - BITS)).astype(np.int32), per_text


@dataclass
class Rows:
    """Training rows one after the other: features, values, where each row ends, and labels."""

    at: np.ndarray
    x: np.ndarray
    ends: np.ndarray
    labels: np.ndarray

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        first = 0
        for end, label in zip(self.ends, self.labels, strict=True):
            yield self.at[first:end], self.x[first:end], label
            first = end


def follow_leader(parts: list[Rows], size: int, passes: int) -> np.ndarray:
    """Weights of ``size`` features and, last, of the constant, from the rows of all parts in turn."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) > L1, w, 0.0), n[at]

    for _ in range(passes):
        for at, x, label in chain.from_iterable(parts):
            w, before = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
            after = before + g * g
            z[at] += g - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
            n[at] = after
    return weights(np.arange(size + 1))[0]


def training_rows(texts: pa.Array, labels: list[int]) -> list[Rows]:
    """The rows of the texts, a part for each slice of them: distinct features with their shares, and the constant."""
    parts, done = [], 0
    for part in slices(texts, FEATURE_BYTES):
        flat, lengths = features(part)
        ats, xs = [], []
        for own in np.split(flat, np.cumsum(lengths)[:-1]):
            feature, count = np.unique(own, return_counts=True)
            ats.append(np.append(feature, np.int32(1 << BITS)))
            xs.append(np.append(count / max(1, len(own)) * SCALE, 1.0).astype(np.float32))
        ends = np.cumsum([len(a) for a in ats])
        here = np.array(labels[done : done + len(ats)], dtype=np.int64)
        parts.append(Rows(np.concatenate(ats), np.concatenate(xs), ends, here))
        done += len(ats)
    return parts


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, folds: int = FOLDS, out: int = OUT) -> np.ndarray:
    """Weights, from about ``sample`` labelled rows outside the held-out fold; all zero where there are none."""
    drawn = labelled_sample(docs, labels, "quality", folds, out, sample)
    one = drawn.repartition(1).sortWithinPartitions(F.xxhash64("text"), "text", "label")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            parts += training_rows(batch["text"], batch["label"].to_pylist())
        w = follow_leader(parts, 1 << BITS, PASSES)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "weight"])

    weights = np.zeros((1 << BITS) + 1)
    # At most 2 ** BITS + 1 rows.
    for row in one.mapInArrow(train, "at long, weight double").collect():
        weights[row.at] = row.weight
    return weights


def scored(text: Column, weights: np.ndarray, spark) -> Column:
    """The score of a column of texts, 0 to 1; of an empty or null text what the constant gives."""
    shared = spark.sparkContext.broadcast(weights)

    def of(texts: pa.Array) -> pa.Array:
        w, found = shared.value, [np.zeros(0)]
        for part in slices(texts, FEATURE_BYTES):
            flat, lengths = features(part)
            found.append(sums(w[flat], lengths) / np.maximum(1, lengths) * SCALE + w[-1])
        return pa.array(1 / (1 + np.exp(-np.concatenate(found))))

    return F.arrow_udf(of, DoubleType())(text)


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``.

    Held out is a row whose id's crc32 is 1 modulo 3, or that has no id. Only ``text`` is an input of the score. Rows alike in text
    score alike. Without any usable label every score is 0.5.
    """
    weights = fit(docs, labels, sample)
    out = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, OUT).alias("held_out"), "text")
    out = out.withColumn("score", scored(F.col("text"), weights, docs.sparkSession))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows that the classifier does not reject, with all their columns.

    A row goes if its score is under 0.5; null and empty texts score what the constant gives, rows alike in text go or stay
    together, and a text of any length counts whole. Without any usable label, or any row, nothing goes.
    """
    weights = fit(docs, labels, sample)
    rows = docs.select(F.struct("*").alias("row"), "text")
    kept_rows = rows.withColumn("score", scored(F.col("text"), weights, docs.sparkSession)).filter("score >= 0.5")
    return kept_rows.select("row.*")
