"""Shared by the operators of this subpackage: words, folds, labelled samples, tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.scratch import kept as kept

#: A word is a longest run without the ASCII white space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are split into words in pieces of about this many bytes, so that a batch's arrays stay small.
SLICE_BYTES = 4 << 20


def word_count(text: Column) -> Column:
    """Number of words; none for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column, folds: int, out: int) -> Column:
    """True for rows never learned from; rows without an id are among them."""
    return F.coalesce(fold(doc_id, folds) == out, F.lit(True))


def one_label_per_id(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label): rows without id or label do not count; of several labels of an id the largest does."""
    named = labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return named.dropna().groupBy("doc_id").agg(F.max("label").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, out: int, bound: int) -> DataFrame:
    """(text, label) of about ``bound`` labelled ids outside the held-out fold, all where there are fewer; one text an id.

    Ids are chosen by their hash against a share, so no sort and no collect is needed; the number is exact up to the
    chance of a draw. Of several texts of an id the smallest is taken, picked before the shuffle.
    """
    known = one_label_per_id(labels, label).filter(~held_out(F.col("doc_id"), folds, out))
    share = min(1.0, bound / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(label)), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(drawn, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return found.select("text", "label")


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The texts in order, in runs of about ``size`` bytes; a longer text is a run of its own."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    first, n = 0, len(texts)
    while first < n:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield pc.fill_null(texts.slice(first, last - first), "")
        first = last
    # A worker lives on after its task: what the pool kept of this batch goes back.
    pa.default_memory_pool().release_unused()


def words_of(texts: pa.Array, lower: bool = True) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, index of each word in turn, number of words of each text). Lower-cases A-Z only."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    full = np.asarray(pc.binary_length(flat)) > 0
    per_text = np.diff(np.asarray(lists.offsets, dtype=np.int64))
    of_text = np.repeat(np.arange(len(lists)), per_text)[full]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    codes = np.asarray(coded.indices, dtype=np.int64)
    return coded.dictionary.to_pylist(), codes, np.bincount(of_text, minlength=len(lists))


def sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of each run of ``lengths`` values in turn; 0 for an empty run."""
    out = np.zeros(len(lengths), dtype=values.dtype)
    full = lengths > 0
    if full.any():
        starts = np.concatenate(([0], np.cumsum(lengths[full])[:-1]))
        out[full] = np.add.reduceat(values, starts)
    return out
