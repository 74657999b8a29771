"""Mixing sources to target weights by weighted fair queueing.

Within its source each document has a place in a shuffled queue. Its virtual finish time is the words of the source up
to and with it, divided by the source's target: a source's queue passes 1 when its target is met. Sources whose target
exceeds their size are queued again, up to three times. All documents in the order of their finish times, truncated
where the total budget is spent, are the mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import kept, word_count
from daybook.llm.prefix import running

WEIGHTS = (1, 2, 3)
#: How often a document may come at most.
REPEATS = 3
#: Rows that a range of an order should hold.
RANGE_ROWS = 2048
#: Digits of the MD5 that shuffles a queue which name a range: 32 bits.
DIGITS = 8
#: Words of the mix that an output part should hold at most.
PART_WORDS = 1 << 22


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with ``source_rank``, ``weight`` and ``target``.

    Sources in order of code point, null last, take the weights in turn and share the total size. A target stops at
    ``most`` times its source's size; the excess goes to the others by weight. With the sources in order of cap per
    weight, those before some place are at their cap and those behind it share the rest: the level at each place
    shows where that is. One row a source: windows over all of them in one task.
    """
    everything, by_name = Window.partitionBy(F.lit(0)), [F.col("source").asc_nulls_last()]
    ranked = sizes.withColumn("source_rank", F.row_number().over(everything.orderBy(*by_name)) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    capped = ranked.withColumn("weight", weight).withColumn("__cap", F.col("source_size") * most)
    upward = everything.orderBy(F.col("__cap") / F.col("weight"), "source_rank")
    earlier = upward.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(earlier), F.lit(0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    leveled = capped.withColumn("__level", rest.cast("double") / weights_left)
    # From the first source on whose cap is above the level before it, that level holds.
    open_ = F.col("__cap") > F.col("__level") * F.col("weight")
    level = F.first(F.when(open_, F.col("__level")), ignorenulls=True).over(
        upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    leveled = leveled.withColumn("__first", level)
    target = F.when(F.col("__first").isNull(), F.col("__cap").cast("double")).otherwise(
        F.least(F.col("__cap").cast("double"), F.col("__first") * F.col("weight"))
    )
    return leveled.select("source", "source_size", "source_rank", "weight", target.alias("target"))


def ranges(count: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(count / RANGE_ROWS)).cast("long")


def unit_key(doc_id: str, text: str) -> Column:
    """The shuffle key: a hash of text and id, so that neither a repeated id nor rows without one share a place."""
    text_md5 = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.md5(F.concat(text_md5, F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))


def queue(docs: DataFrame, weights: tuple[int, ...], most: int) -> tuple[DataFrame, DataFrame]:
    """(units, sources). A unit is the ``n`` rows alike in source, text and id, added up before any shuffle of them;
    ``start`` are the words of its source's queue before it."""
    digest = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), unit_key("doc_id", "text").alias("h"))
    units = kept(digest.groupBy("source", "h", "doc_id", "size").agg(F.count("*").alias("n")), "units")
    mass = (F.col("size") * F.col("n")).alias("mass")
    totals = units.groupBy("source").agg(F.sum(mass).alias("source_size"), F.count("*").alias("units"), F.sum("n").alias("rows"))
    totals = kept(totals, "sources")
    sources = targets(totals.select("source", "source_size"), weights, most).join(
        totals.select(F.col("source").alias("s"), "units", "rows"), F.col("source").eqNullSafe(F.col("s"))
    )
    sources = kept(sources.drop("s"), "targets")
    share = F.conv(F.substring("h", 1, DIGITS), 16, 10).cast("long")
    named = sources.select(F.col("source").alias("s"), "source_rank", "source_size", "target", "units")
    dealt = units.select("*", mass).join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = dealt.withColumn("range", F.floor(share * ranges(F.col("units")) / (1 << (4 * DIGITS))))
    return running(dealt, ["source_rank"], [F.col("h")], "mass", "start").drop("range", "mass", "units"), sources


def spelled(units: DataFrame) -> DataFrame:
    """A row for each document of the units, the ``nth`` of its unit, with its own ``start``.

    A unit of many rows is dealt out in blocks of RANGE_ROWS, so no task spells out a third of the table.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RANGE_ROWS))).alias("block")
    many = units.filter(F.col("n") > RANGE_ROWS).select("*", blocks).repartition("h", "block")
    few = units.filter(F.col("n") <= RANGE_ROWS).select("*", F.lit(0).cast("long").alias("block"))
    first = F.col("block") * RANGE_ROWS
    nth = F.explode(F.sequence(first, F.least(first + RANGE_ROWS, F.col("n")) - 1))
    rows = few.unionByName(many).withColumn("nth", nth)
    return rows.withColumn("start", F.col("start") + F.col("nth") * F.col("size")).drop("block", "n")


def copies(rows: DataFrame, most: int, cut: bool) -> DataFrame:
    """A row for each time that a document stands in its source's queue: its ``words`` and its virtual ``finish`` time.

    With ``cut``, the copy on which a source meets its target has the words up to it only, and finishes at 1.
    """
    again = rows.filter((F.col("size") > 0) & (F.col("target") > 0))
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    first = F.col("copy") * F.col("source_size") + F.col("start")
    last, goal = first + F.col("size"), F.floor("target").cast("long")
    whole = again.withColumn("words", F.col("size")).withColumn("finish", last.cast("double") / F.col("target"))
    if not cut:
        return whole
    meets = (first < F.col("target")) & (last > F.col("target"))
    part = whole.withColumns(
        {"words": F.when(meets, goal - first).otherwise(F.col("words")), "finish": F.when(meets, 1.0).otherwise(F.col("finish"))}
    )
    return part.filter("words > 0")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = REPEATS, cut: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, mixed, sources): every document with its place in its queue; the mix; the sources with their targets.

    ``mixed`` has a row for each time that the mix takes a document, with the ``words`` taken, its ``finish`` time and
    ``offset``, the words of the mix before it. Documents are taken whole, and a source ends within a document or so
    of its target; with ``cut`` the copy that crosses the target is cut there, and it ends on it. ``rows`` and ``mixed``
    share the key (source_rank, h, nth). Of rows alike in id, source and text, any may be the one taken more often.
    Documents without words, and null texts, have size 0 and are never taken; null sources are a source of their own.
    """
    units, sources = queue(docs, weights, most)
    rows = spelled(kept(units, "queue"))
    total = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("budget"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    ).first()
    # A queue runs evenly through the ranges of finish times, so a range holds RANGE_ROWS or fewer on average.
    parts = max(1, -(-total.rows * most // RANGE_ROWS))
    in_line = copies(rows, most, cut).withColumn("range", F.floor(F.col("finish") * parts))
    order = [F.col("finish"), F.col("source_rank"), F.col("copy"), F.col("h"), F.col("nth")]
    placed = running(in_line, [], order, "words", "offset")
    return rows, placed.filter(F.col("offset") + F.col("words") <= total.budget).drop("range"), sources


def taken(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = REPEATS, cut: bool = True) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of each document."""
    rows, mixed, _ = mix(docs, weights, most, cut)
    key = ["source_rank", "h", "nth"]
    words = mixed.groupBy(*key).agg(F.sum("words").alias("taken"))
    out = rows.join(words, key, "left")
    return out.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = REPEATS) -> DataFrame:
    """The documents of the mix with their columns, in its order, each as often as the mix takes it.

    Output parts are equal runs of the mix's words. A text goes to its places in the mix by one join, once for each
    part that has it, and to the part by one exchange; its times within the part are spelled out there. Rows alike in
    id, source and text become one row before the join, which stands for all of them: any, where other columns differ.
    """
    _, mixed, sources = mix(docs, weights, most)
    budget = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-budget // PART_WORDS))
    part = F.floor(F.col("offset") / F.lit(max(1, -(-budget // parts)))).cast("int")
    # One text for h and source, nulls included.
    key = F.concat("h", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source"))))
    times = mixed.select(key.alias("key"), part.alias("part"), "offset")
    times = times.groupBy("key", "part").agg(F.collect_list("offset").alias("offsets"))
    rows = docs.select(F.struct("*").alias("row"), unit_key("doc_id", "text").alias("h"), "source")
    rows = rows.select("row", key.alias("key")).groupBy("key").agg(F.first("row").alias("row"))
    joined = rows.join(times, "key").select("row", "part", "offsets").repartitionById(parts, F.col("part"))
    return joined.select("row", F.explode("offsets").alias("offset")).sortWithinPartitions("offset").select("row.*")
