"""Removal of lines that stand on many sites.

Per line, a HyperLogLog sketch of the sites it stands on is merged by aggregation. Lines whose estimate is clearly over
or under the threshold are settled by it; those near it get an exact count. A line over the threshold stays where it
comes first and goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import kept, word_count

#: A line on one in so many of all sites is boilerplate, and on FEWEST at least; a line of more than LONG words on FEWEST alone.
ONE_IN = 5
FEWEST = 2
LONG = 50
#: Every line with a word is looked at, however short: the spread over sites tells boilerplate from chance.
WORDS = 1
#: Sketches have 2 to this power registers; up to a few hundred sites they count all but exactly.
LOG_REGISTERS = 12
#: An estimate within this share of the threshold is near it: over ten standard errors of such a sketch.
NEAR = 0.25


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> list[Column]:
    """96 bits for a line without its outer white space."""
    line = F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    return [F.xxhash64(line).alias("k1"), F.hash(line).alias("k2")]


def threshold(docs: DataFrame, one_in: int = ONE_IN, fewest: int = FEWEST) -> int:
    """Sites that a line must stand on, by the number of distinct sites of the table."""
    sites = docs.agg(F.count_distinct("source").alias("n")).first().n
    return max(fewest, -(-sites // one_in))


def lines(docs: DataFrame, words: int, long: int = LONG) -> DataFrame:
    """(doc_id, t, site, place, long, k1, k2) of each line with enough words. ``t`` tells texts under one id apart."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("t"), F.col("source").alias("site"), F.posexplode(text_lines(F.col("text"))))
    counted = rows.withColumn("n", word_count(F.col("col"))).filter(F.col("n") >= words)
    return counted.select("doc_id", "t", "site", F.col("pos").alias("place"), (F.col("n") > long).alias("long"), *line_key(F.col("col")))


def first_place() -> Column:
    """What orders the places of a line: by id, rows without one last, then by text and place."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("t"), F.col("place"))


def boilerplate(
    found: DataFrame, sites: int, fewest: int = FEWEST, log_registers: int = LOG_REGISTERS, near: float = NEAR
) -> DataFrame:
    """(k1, k2, first) of the lines on enough distinct sites, with their first place; a null site is no site.

    Enough are ``sites``, and ``fewest`` for a long line.
    """
    # Sketches leave nulls out. A line's rows are combined before the shuffle, however many they are.
    sketches = found.groupBy("k1", "k2").agg(
        F.hll_sketch_agg("site", log_registers).alias("sketch"), F.min(first_place()).alias("first"), F.max("long").alias("long")
    )
    enough = F.when(F.col("long"), fewest).otherwise(sites)
    spread = sketches.select("k1", "k2", "first", F.hll_sketch_estimate("sketch").alias("about"), enough.alias("enough"))
    spread = kept(spread.filter(F.col("about") >= F.col("enough") * (1 - near)), "spread")
    is_sure = F.col("about") > F.col("enough") * (1 + near)
    sure, close = spread.filter(is_sure).drop("about", "enough"), spread.filter(~is_sure).drop("about")
    pairs = found.select("k1", "k2", "site").join(close, ["k1", "k2"], "left_semi").distinct()
    counts = pairs.groupBy("k1", "k2").agg(F.count("site").alias("n"))
    return sure.union(close.join(counts, ["k1", "k2"]).filter(F.col("n") >= F.col("enough")).select(*sure.columns))


def removals(docs: DataFrame, sites: int, words: int, long: int) -> DataFrame:
    """(doc_id, t, places): the lines to take out of each text that has any."""
    found = kept(lines(docs, words, long), "lines")
    wide = kept(boilerplate(found, sites, min(FEWEST, sites)), "boilerplate")
    spare = found.join(wide, ["k1", "k2"]).filter(first_place() != F.col("first"))
    return spare.groupBy("doc_id", "t").agg(F.collect_set("place").alias("places"))


def cleaned(docs: DataFrame, sites: int | None = None, words: int = WORDS, long: int = LONG) -> DataFrame:
    """(row, text, lines, removed) of each row of ``docs``: the whole row, its text without the lines that go, counts.

    Lines are compared without outer white space, by 96 bits of hash; what stays is unchanged. A line goes that stands on
    ``sites`` sites or more, by default a share of the table's (see :func:`threshold`); one of more than ``long`` words goes
    at two. A line of fewer than ``words`` words stays. Null texts stay null, a text all of whose lines go becomes empty; no
    row goes. Rows alike in id and text are one text: the first line of such rows stays in each.
    """
    sites = threshold(docs) if sites is None else sites
    spare = removals(docs, sites, words, long).select(F.col("doc_id").alias("id"), F.col("t").alias("spare_t"), "places")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "text", F.xxhash64("text").alias("t"))
    joined = rows.join(spare, (F.col("t") == F.col("spare_t")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")
    stays = F.filter(text_lines(F.col("text")), lambda line, i: ~F.array_contains(F.col("places"), i))
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    total = F.when(F.col("text").isNull(), 0).otherwise(F.size(text_lines(F.col("text"))))
    return joined.select("row", text.alias("text"), total.alias("lines"), F.coalesce(F.size("places"), F.lit(0)).alias("removed"))
