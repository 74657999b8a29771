"""The balance fact, kept up to date from what changed.

Beside the fact's months lie the points it follows from: for each holder, the days on which a new balance begins to hold.
A refresh takes the holders that changed and the first day of each on which anything did. It works out their points from
that day on, compares the steps before and after, and writes the months in which they differ, or that are new. Points lie in
buckets of the holder; all other buckets and months keep their files. One commit names the attempt that wrote each.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.balances import daily_points, in_range_order, split_months, tiled
from daybook.operators.steps import as_steps, changes, steps_of
from daybook.plans.dimensions import DEPOSITS, LOANS, Ledger, Run, Tables, placed_accounts
from daybook.plans.facts import INTERVAL, Span, fact_rows, ledger_txns, named_intervals
from daybook.plans.targets import TARGETS
from daybook.sinks.buckets import BUCKET, Directory, rows_per_bucket, write_buckets, written_sizes
from daybook.sinks.versions import attempt_path, commit_version, latest_commit, new_attempt, refuse_committed

LEDGERS = (LOANS, DEPOSITS)
POINTS = T.StructType(
    [T.StructField("kind", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ("holder", "account_id", "institution_id")]
    + [T.StructField("day", T.DateType()), T.StructField("balance", T.DecimalType(18, 2))]
)
_HOLDER = ["kind", "holder"]
_PLACED = [*_HOLDER, "account_id", "institution_id"]
#: Bytes of points that a bucket may have before it splits.
BUCKET_BYTES = 256 << 20


def touched_holders(ledger: Ledger, *versions: DataFrame) -> DataFrame:
    """``kind, holder, since``: the first day of each holder among the transactions that changed.

    Give the rows as they are now and as they were: one that went, moved to another day or holder, or no longer counts
    touches the day it stood on. Rows without a day touch none.
    """
    rows = reduce(DataFrame.unionByName, (v.select(ledger.txn_holder, F.to_date("date").alias("date")) for v in versions))
    dated = rows.filter(F.col("date").isNotNull())
    first = dated.groupBy(F.lit(ledger.prefix).alias("kind"), F.col(ledger.txn_holder).cast("bigint").alias("holder"))
    return first.agg(F.min("date").alias("since"))


def create_fact(
    spark: SparkSession,
    tables: Tables,
    run: Run,
    loans: Span,
    deposits: Span,
    root: str,
    version: str,
    bucket_bytes: int = BUCKET_BYTES,
) -> list[str]:
    """Build the fact of both ledgers under ``root`` for later refreshes; returns its months."""
    refuse_committed(spark, root, version)
    spans = dict(zip((ledger.prefix for ledger in LEDGERS), (loans, deposits), strict=True))
    attempt = new_attempt(version)
    path = attempt_path(root, attempt)
    found = [
        daily_points(ledger_txns(tables, ledger), ledger.txn_holder, spans[ledger.prefix].start, spans[ledger.prefix].end)
        .withColumnRenamed(ledger.txn_holder, "holder")
        .withColumn("kind", F.lit(ledger.prefix))
        for ledger in LEDGERS
    ]
    points = _kept(_placed(found[0].unionByName(found[1]), tables), f"{path}/staged")
    size = sum(written_sizes(spark, f"{path}/staged", "any").values())
    directory = Directory.of_bytes(size, bucket_bytes)
    written = sorted(rows_per_bucket(points, directory, tuple(_HOLDER)))
    sizes = directory.expected({1: size})
    write_buckets(points, directory, tuple(_HOLDER), {b: sizes[b] for b in written}, f"{path}/points")
    months = set().union(*(_month_starts(span.start, span.end) for span in spans.values()))
    _write_months(_read_points(spark, {b: path for b in written}), spans, months, run, path)
    return _commit(spark, root, version, attempt, {}, directory, written, {}, spans, months)


def refresh_fact(
    spark: SparkSession,
    tables: Tables,
    touched: DataFrame,
    run: Run,
    loans: Span,
    deposits: Span,
    root: str,
    version: str,
    bucket_bytes: int = BUCKET_BYTES,
) -> list[str]:
    """Bring the fact under ``root`` up to date; returns the months that were written.

    ``tables`` are the source tables as they are now, ``touched`` the holders whose transactions changed (see
    :func:`touched_holders`), late and withdrawn ones among them. Holders that moved to another account, or whose account
    moved, are found here. The spans start as they did and may end later, not earlier. The result is what a full
    build gives, but for the upload time of rows in months that stay.
    """
    refuse_committed(spark, root, version)
    last = latest_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing committed under {root}")
    state = json.loads(last.layout)
    before = {kind: Span(*map(date.fromisoformat, days)) for kind, days in state["spans"].items()}
    spans = dict(zip((ledger.prefix for ledger in LEDGERS), (loans, deposits), strict=True))
    for kind, span in spans.items():
        if span.start != before[kind].start or span.end < before[kind].end:
            raise ValueError(f"the series of {kind} is {before[kind]}; a refresh may only end later")
    attempt = new_attempt(version)
    path = attempt_path(root, attempt)
    known = Directory({int(b): size for b, size in state["sizes"].items()})
    paths = {b: attempt_path(root, a) for b, a in last.parts.items()}
    old = _read_points(spark, paths)

    # Everything about a holder that moved is new, and so is a day that was beyond the end of the series.
    starts = _by_kind({kind: span.start for kind, span in spans.items()})
    places = old.groupBy(*_PLACED).agg(F.lit(0).alias("old"))
    now = _placed(places.select(*_HOLDER), tables).toDF("k", "h", "a", "i")
    moved = places.join(now, _same_holder("h"), "left").filter(
        ~(F.col("account_id").eqNullSafe(F.col("a")) & F.col("institution_id").eqNullSafe(F.col("i")))
    )
    given = touched.select(*_HOLDER, F.greatest("since", starts).alias("since"))
    late = [
        touched_holders(ledger, ledger_txns(tables, ledger).filter(F.col("date") > F.lit(before[ledger.prefix].end))) for ledger in LEDGERS
    ]
    everything = reduce(DataFrame.unionByName, [given, moved.select(*_HOLDER, starts.alias("since")), *late])
    since = _kept(everything.groupBy(*_HOLDER).agg(F.min("since").alias("since")), f"{path}/touched")

    counts = rows_per_bucket(since, known, tuple(_HOLDER))
    held = _read_points(spark, {b: p for b, p in paths.items() if b in counts})
    by_holder = since.select(F.col("kind").alias("k"), F.col("holder").alias("h"), "since")
    marked = held.join(by_holder, _same_holder("h"), "left").drop("k", "h")
    fresh = _kept(_fresh_points(tables, since, marked, spans), f"{path}/fresh")
    fresh_bytes = sum(written_sizes(spark, f"{path}/fresh", "any").values())
    share = fresh_bytes / max(1, sum(counts.values()))
    expected = {b: known.sizes[b] + round(n * share) for b, n in counts.items()}
    directory = known.split(expected, bucket_bytes)
    sizes = directory.expected(expected)
    written = sorted(sizes)
    staying = marked.filter(F.col("since").isNull()).drop("since")
    write_buckets(staying.unionByName(fresh), directory, tuple(_HOLDER), sizes, f"{path}/points")

    rows = [held.count(), fresh.count()]
    was = _tiles(marked.filter(F.col("since").isNotNull()).drop("since"), before, rows[0])
    months = _months(_differing(was, _tiles(fresh, spans, rows[1]), sum(rows)))
    for kind, span in spans.items():
        months |= {m for m in _month_starts(before[kind].end, span.end) if span.end > before[kind].end}
    there = set(written_sizes(spark, f"{path}/points"))
    paths = {b: p for b, p in paths.items() if b not in counts} | {b: path for b in written if str(b) in there}
    _write_months(_read_points(spark, paths), spans, months, run, path)
    parts = {b: a for b, a in last.parts.items() if b not in counts}
    return _commit(spark, root, version, attempt, parts, directory, written, state["months"], spans, months)


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    """The fact as of its latest commit."""
    last = latest_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing committed under {root}")
    months = json.loads(last.layout)["months"]
    schema = TARGETS["fact_balance_subaccount"].schema
    paths = [f"{attempt_path(root, a)}/fact/month={m}" for m, a in sorted(months.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _placed(rows: DataFrame, tables: Tables) -> DataFrame:
    """Rows of ``kind, holder`` with the holder's account and institution."""
    holders = [
        tables[ledger.holders].select(F.lit(ledger.prefix).alias("k"), F.col("id").alias("h"), "account_id") for ledger in LEDGERS
    ]
    places = holders[0].unionByName(holders[1]).join(placed_accounts(tables), "account_id", "left")
    found = rows.join(places, (F.col("kind") == F.col("k")) & (F.col("holder") == F.col("h")), "left").drop("k", "h")
    typed = {f.name: F.col(f.name).cast(f.dataType) for f in POINTS if f.name in found.columns}
    return found.select(*(c.alias(name) for name, c in typed.items()))


def _fresh_points(tables: Tables, since: DataFrame, marked: DataFrame, spans: Mapping[str, Span]) -> DataFrame:
    """All points of the touched holders that still have transactions: earlier ones as they were, later ones anew."""
    found = []
    for ledger in LEDGERS:
        mine = since.filter(F.col("kind") == ledger.prefix).select(F.col("holder").alias("h"), "since")
        txns = ledger_txns(tables, ledger)
        txns = txns.join(mine, F.col(ledger.txn_holder).eqNullSafe(F.col("h"))).drop("h")
        points = daily_points(txns, ledger.txn_holder, F.col("since"), spans[ledger.prefix].end)
        found.append(points.select(F.lit(ledger.prefix).alias("kind"), F.col(ledger.txn_holder).cast("bigint").alias("holder"), "day", "balance"))
    later = found[0].unionByName(found[1])
    active = later.select(F.col("kind").alias("k"), F.col("holder").alias("h")).distinct()
    earlier = marked.filter(F.col("day") < F.col("since")).select(*_HOLDER, "day", "balance")
    earlier = earlier.join(active, _same_holder("h"), "left_semi")
    return _placed(earlier.unionByName(later), tables).select(*POINTS.fieldNames())


def _same_holder(other: str) -> Column:
    """Join condition: of one ledger, and the same holder, which may be null; the other side has it as ``other``."""
    return F.col("kind").eqNullSafe(F.col("k")) & F.col("holder").eqNullSafe(F.col(other))


def _by_kind(days: Mapping[str, date]) -> Column:
    return F.create_map(*(F.lit(v) for pair in days.items() for v in pair))[F.col("kind")]


def _tiles(points: DataFrame, spans: Mapping[str, Span], rows: int) -> DataFrame:
    """Intervals of the placed holders, each ledger over its own span; ``rows`` is about how many points there are."""
    who = F.struct(*_PLACED).alias("who")
    found = [
        tiled(points.filter(F.col("kind") == kind).select(who, "day", "balance"), "who", span.start, span.end, rows=rows).select(
            "who.*", *INTERVAL
        )
        for kind, span in spans.items()
    ]
    return reduce(DataFrame.unionByName, found)


def _differing(before: DataFrame, after: DataFrame, rows: int) -> DataFrame:
    """``first_day, last_day`` of stretches in which a placed holder's balance is another, or is there on one side only."""
    old, new = (as_steps(side) for side in (before, after))
    zero = F.lit(0).cast("decimal(18,2)")
    signed = new.withColumn("side", F.lit(1)).unionByName(
        old.withColumns({"balance": zero - F.col("balance"), "side": F.lit(-1)})
    )
    values = ["balance", "side"]
    left = steps_of(changes(signed, _PLACED, values), _PLACED, values, rows=rows)
    return left.filter((F.col("balance") != 0) | (F.col("side") != 0)).select("first_day", "last_day")


def _months(stretches: DataFrame) -> set[str]:
    """First days of the months that the stretches lie in: one small row a month of the series."""
    months = F.sequence(F.trunc("first_day", "month"), F.col("last_day"), F.expr("interval 1 month"))
    return {r.month.isoformat() for r in stretches.select(F.explode(months).alias("month")).distinct().collect()}


def _month_starts(first: date, last: date) -> set[str]:
    count = (last.year - first.year) * 12 + last.month - first.month
    starts = (divmod(first.month - 1 + i, 12) for i in range(count + 1))
    return {date(first.year + years, month + 1, 1).isoformat() for years, month in starts}


def _write_months(points: DataFrame, spans: Mapping[str, Span], months: set[str], run: Run, path: str) -> None:
    """Spell out the given months of all holders, from their points there and the last one before."""
    if not months:
        return
    first, last = F.lit(date.fromisoformat(min(months))), F.last_day(F.lit(date.fromisoformat(max(months))))
    earlier = points.filter(F.col("day").isNull() | (F.col("day") < first))
    # A point a day: by the day alone, which is grouped without sorting the points.
    opening = earlier.groupBy(*_PLACED).agg(F.max("day").alias("day"), F.max_by("balance", "day").alias("balance"))
    within = points.filter((F.col("day") >= first) & (F.col("day") <= last))
    tiles = _tiles(opening.unionByName(within), spans, points.count()).withColumns(
        {"first_day": F.greatest("first_day", first), "last_day": F.least("last_day", last)}
    )
    tiles = tiles.filter(F.col("first_day") <= F.col("last_day"))
    named = [named_intervals(tiles.filter(F.col("kind") == ledger.prefix), ledger) for ledger in LEDGERS]
    wanted = F.col("month").isin([date.fromisoformat(m) for m in sorted(months)])
    pieces = split_months(named[0].unionByName(named[1])).filter(wanted)
    # The writer sorts a task's days by their month.
    days = _days_written(points, spans, months)
    rows = fact_rows(in_range_order(pieces, "month", "subaccount_id", "first_day", rows=days), run)
    writer = rows.withColumn("month", F.trunc("date", "month")).write.mode("errorifexists").option("compression", "zstd")
    writer.partitionBy("month").parquet(f"{path}/fact")


def _days_written(points: DataFrame, spans: Mapping[str, Span], months: Collection[str]) -> int:
    """About how many days the holders of the points have in the given months."""
    holders = points.groupBy("kind").agg(F.approx_count_distinct(F.struct("holder", "account_id", "institution_id")).alias("n"))
    total = 0
    for r in holders.collect():  # a row a ledger
        span = spans[r.kind]
        total += r.n * sum((span.start + timedelta(i)).replace(day=1).isoformat() in months for i in range((span.end - span.start).days + 1))
    return total


def _commit(
    spark: SparkSession,
    root: str,
    version: str,
    attempt: str,
    parts: Mapping[int, str],
    directory: Directory,
    written: list[int],
    old_months: Mapping[str, str],
    spans: Mapping[str, Span],
    months: set[str],
) -> list[str]:
    path = attempt_path(root, attempt)
    found = {int(b): size for b, size in written_sizes(spark, f"{path}/points").items()}
    filled = written_sizes(spark, f"{path}/fact", "month") if months else {}
    layout = {
        "sizes": dict(directory.measured(written, found).sizes),
        "months": {m: a for m, a in old_months.items() if m not in months} | dict.fromkeys(filled, attempt),
        "spans": {kind: [span.start.isoformat(), span.end.isoformat()] for kind, span in spans.items()},
    }
    commit_version(spark, root, version, attempt, {**parts, **dict.fromkeys(found, attempt)}, json.dumps(layout))
    return sorted(months)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _read_points(spark: SparkSession, paths: Mapping[int, str]) -> DataFrame:
    files = [f"{path}/points/{BUCKET}={b}" for b, path in sorted(paths.items())]
    return spark.read.schema(POINTS).parquet(*files) if files else spark.createDataFrame([], POINTS)
