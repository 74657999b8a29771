"""Which sources of a language use which words, and how far their vocabularies are apart, in exact numbers.

A source's share of a word, smoothed and in parts per billion, depends on its count alone, and how far it is from the
language's share on two counts. So words are grouped into cells by their count in the source and in the language. A
cell's difference is worked out once; cells are ranked by it, with the words they hold; equal differences become one
value; and the words of the values that reach the wanted rank are spelled out last, in the order of their bytes.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import kept, slices

#: Documents of its language that a word must stand in to be kept.
LEAST_DOCS = 30
#: Added to every count of a kept word.
SMOOTHING = 5
SCALE_STEPS = 3
#: Words reported of a group.
RANKS = 50
#: Counts that a task holds before it hands them on; the shuffle adds up what comes in several parts.
HELD = 1 << 18
#: Entries of a matrix of words by sources, and of one of sources by sources that a task holds.
BLOCK = 1 << 21

# Letters of ASCII in lower case, and every byte of a character beyond ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_COUNTS = "lang string, source string, term string, n long, docs long"
_PAIRS = "lang string, source string, item string, value long"


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, in parts to be added up.

    A row with a null term stands for the group itself, and counts its documents; so groups without terms are there too.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple, Counter] = defaultdict(Counter)
        within: dict[tuple, Counter] = defaultdict(Counter)
        held = 0
        for batch in batches:
            groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True))
            done = 0
            for part in slices(batch.column("text")):
                for text in pc.ascii_lower(part).cast(pa.binary()):
                    group, words = groups[done], Counter(_TERM.findall(text.as_buffer()))
                    done += 1
                    all_n, all_docs = n[group], within[group]
                    held -= len(all_n)
                    all_n.update(words)
                    all_docs.update(words.keys())
                    all_docs[None] += 1
                    held += len(all_n)
                    if held > HELD:
                        yield _counted(n, within)
                        n.clear()
                        within.clear()
                        held = 0
        if within:
            yield _counted(n, within)

    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    named = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))
    return docs.select(text, *named).mapInArrow(count, _COUNTS)


def _counted(n: dict[tuple, Counter], within: dict[tuple, Counter]) -> pa.RecordBatch:
    columns = ([], [], [], [], [])
    for (lang, source), docs in within.items():
        occurs = n[lang, source]
        columns[0].extend([lang] * len(docs))
        columns[1].extend([source] * len(docs))
        columns[2].extend(docs)
        columns[3].extend(occurs[t] for t in docs)
        columns[4].extend(docs.values())
    terms = pa.array(columns[2], pa.binary()).cast(pa.string())
    kinds = [pa.string(), pa.string(), None, pa.int64(), pa.int64()]
    arrays = [terms if k is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["lang", "source", "term", "n", "docs"])


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, lang_n, by_source): counts of each kept term by source; a null term lists all groups of the language.

    One shuffle, by language and term. A term's list is as long as the language has sources.
    """
    parts = count_terms(docs).repartition("lang", "term")
    counts = parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("source", "n")).alias("by_source")
    )
    return terms.filter(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs")


def group_totals(terms: DataFrame) -> DataFrame:
    """(lang, source, total, terms, lang_total): one small row a group."""

    def of_terms(count: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("term").isNotNull(), F.col(count))), F.lit(0))

    langs = terms.groupBy("lang").agg(F.count("term").alias("terms"), of_terms("lang_n").alias("lang_total"))
    each = terms.select("lang", "term", F.explode("by_source").alias("s")).select("lang", "term", "s.source", "s.n")
    sums = each.groupBy("lang", "source").agg(of_terms("n").alias("total"))
    return sums.join(langs, "lang").select("lang", "source", "total", "terms", "lang_total")


def share(count: Column, total: Column, terms: Column, smoothing: int = SMOOTHING) -> Column:
    """1 + floor(10**9 * (count + smoothing) / (total + smoothing * terms)), exact while a thousand totals fit a long."""
    whole, rest = F.lit(0).cast("long"), (count + smoothing).cast("long")
    size = (total + smoothing * terms).cast("long")
    for _ in range(SCALE_STEPS):  # long division by thousands
        whole = whole * 1000 + F.call_function("div", rest * 1000, size)
        rest = F.pmod(rest * 1000, size)
    return whole + 1


def shares(counts: np.ndarray, size: int, smoothing: int = SMOOTHING) -> np.ndarray:
    """The same for an array of counts and one size of total and smoothing."""
    whole, rest = np.zeros_like(counts), counts + smoothing
    for _ in range(SCALE_STEPS):
        whole, rest = whole * 1000 + rest * 1000 // size, rest * 1000 % size
    return whole + 1


def term_ranks(terms: DataFrame, totals: DataFrame, ranks: int, smoothing: int) -> DataFrame:
    """(lang, source, item, value, rank) of the terms that a group uses more than its language, as far as ``ranks``."""
    each = terms.filter(F.col("term").isNotNull()).select("lang", "term", "lang_n", F.explode("by_source").alias("s"))
    rows = each.select("lang", "s.source", "term", "s.n", "lang_n")
    cell = ["lang", "source", "n", "lang_n"]
    cells = rows.groupBy(*cell).agg(F.count("*").alias("words")).join(totals, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("terms"), smoothing)
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), smoothing)
    cells = kept(cells.select(*cell, "words", (p - q).alias("value")).filter(F.col("value") > 0), "cells")
    # Each value holds a word or more, so as many values as ranks are enough; that limit applies before the shuffle too.
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    values = cells.groupBy("lang", "source", "value").agg(F.sum("words").alias("words"))
    values = values.withColumn("nth", F.row_number().over(group)).filter(F.col("nth") <= ranks)
    held = F.sum("words").over(group.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("before", F.coalesce(held, F.lit(0))).filter(F.col("before") < ranks)
    wanted = cells.select(*cell, "value").join(values.select("lang", "source", "value", "before"), ["lang", "source", "value"])
    words = rows.join(wanted, cell)
    equal = Window.partitionBy("lang", "source", "value", "before").orderBy("term")
    words = words.withColumn("nth", F.row_number().over(equal)).filter(F.col("nth") <= ranks)
    rank = (F.col("before") + F.col("nth")).cast("int")
    return words.select("lang", "source", F.col("term").alias("item"), "value", rank.alias("rank")).filter(F.col("rank") <= ranks)


def pair_sums(terms: DataFrame, totals: DataFrame, smoothing: int) -> DataFrame:
    """(lang, source, item, value): the sum over all kept terms of how far the shares of two sources are apart.

    The driver and every task hold a row a group; the result has a row for each two groups of a language, so the list is
    as short as the root of it. A task adds up its own terms, a matrix of words by sources at a time.
    """
    sizes: dict[str, list[tuple[str, int]]] = defaultdict(list)
    for r in totals.select("lang", "source", (F.col("total") + smoothing * F.col("terms")).alias("size")).collect():
        sizes[r.lang].append((r.source, r.size))
    for groups in sizes.values():
        groups.sort()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            by_lang: dict[str, list[int]] = defaultdict(list)
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                by_lang[lang].append(i)
            for lang, places in by_lang.items():
                names, n_sources = [s for s, _ in sizes[lang]], len(sizes[lang])
                small = n_sources * n_sources <= BLOCK
                for found in _blocks(batch, places, names, max(1, BLOCK // n_sources)):
                    for i in range(n_sources):
                        found[:, i] = shares(found[:, i], sizes[lang][i][1], smoothing)
                    if small:
                        total = sums.setdefault(lang, np.zeros((n_sources, n_sources), dtype=np.int64))
                    for i in range(n_sources):
                        apart = np.abs(found[:, i + 1 :] - found[:, i : i + 1]).sum(axis=0)
                        if small:
                            total[i, i + 1 :] += apart
                        else:
                            yield from _pairs(lang, names, i, apart)
            if sum(t.size for t in sums.values()) > BLOCK:
                yield from _flush(sums, sizes)
        yield from _flush(sums, sizes)

    known = terms.filter(F.col("term").isNotNull()).select("lang", "by_source")
    found = known.mapInArrow(add, _PAIRS)
    # A language without kept terms has its pairs all the same: every group with every other, at 0.
    groups = totals.select("lang", "source")
    every = groups.join(groups.withColumnRenamed("source", "item"), "lang").filter(F.col("source") != F.col("item"))
    both = found.unionByName(found.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    summed = both.unionByName(every.withColumn("value", F.lit(0).cast("long")))
    return summed.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _blocks(batch: pa.RecordBatch, places: list[int], names: list[str], rows: int) -> Iterator[np.ndarray]:
    """Matrices of counts, a row a term and a column a source, of the given rows of a batch."""
    column = {name: i for i, name in enumerate(names)}
    lists = batch.column("by_source")
    for first in range(0, len(places), rows):
        some = lists.take(pa.array(places[first : first + rows]))
        flat, lengths = some.flatten(), np.asarray(pc.list_value_length(some), dtype=np.int64)
        coded = flat.field("source").dictionary_encode()
        at = np.array([column[s] for s in coded.dictionary.to_pylist()], dtype=np.int64)[np.asarray(coded.indices)]
        counts = np.zeros((len(some), len(names)), dtype=np.int64)
        counts[np.repeat(np.arange(len(some)), lengths), at] = np.asarray(flat.field("n"))
        yield counts


def _pairs(lang: str, names: list[str], i: int, apart: np.ndarray) -> Iterator[pa.RecordBatch]:
    others = names[i + 1 :]
    if others:
        columns = [pa.array([lang] * len(others)), pa.array([names[i]] * len(others)), pa.array(others), pa.array(apart, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "value"])


def _flush(sums: dict[str, np.ndarray], sizes: dict[str, list[tuple[str, int]]]) -> Iterator[pa.RecordBatch]:
    for lang, total in sums.items():
        names = [s for s, _ in sizes[lang]]
        for i in range(len(names)):
            yield from _pairs(lang, names, i, total[i, i + 1 :])
    sums.clear()


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS, smoothing: int = SMOOTHING) -> DataFrame:
    """(lang, source, part, item, value, rank): ``pair`` rows for every two sources of a language, ``term`` rows to ``ranks``.

    A term is a run of ASCII letters, in lower case, and characters beyond ASCII. Each row of ``docs`` is a document,
    repeated rows too. Null texts, languages and sources are empty. Every group that occurs has its pairs, also one
    without terms, or whose language keeps no term: their values are then 0. Ranks are by value, then by the bytes of
    the item. A text is counted whole, whatever its length; an empty table gives none. Other columns are not read.
    """
    terms = kept(kept_terms(docs, least_docs), "terms")
    totals = kept(group_totals(terms), "totals")
    pairs = pair_sums(terms, totals, smoothing)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    found = term_ranks(terms, totals, ranks, smoothing)
    columns = ("lang", "source", "part", "item", "value", "rank")
    parts = (rows.withColumn("part", F.lit(part)).select(*columns) for rows, part in ((pairs, "pair"), (found, "term")))
    return next(parts).unionByName(next(parts))
