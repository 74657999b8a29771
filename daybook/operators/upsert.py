"""Key-based changes to a copy of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_version(source: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the newest by ``order``, nulls oldest.

    Combined before the shuffle, so a key with most of the versions is no hot spot.
    """
    rest = [c for c in source.columns if c not in (key, *order)]
    newest = F.max(F.struct(*order, *rest)).alias("__newest")
    picked = source.groupBy(key).agg(newest)
    return picked.select(*(F.col(key) if c == key else F.col(f"__newest.{c}") for c in source.columns))


def split_null_keys(source: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows a merge can place, and rows it must reject because their key is null."""
    return source.filter(F.col(key).isNotNull()), source.filter(F.col(key).isNull())


def fitted(target: DataFrame, source: DataFrame, new_columns: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Both with the target's columns, and those that only the source has: ``new_columns`` is "fail" or "add".

    A column the source lacks is null in its rows. Types follow the target.
    """
    if new_columns not in ("fail", "add"):
        raise ValueError(f"new_columns is 'fail' or 'add', not {new_columns!r}")
    extra = [c for c in source.columns if c not in target.columns]
    if extra and new_columns == "fail":
        raise ValueError(f"the target has no column {', '.join(extra)}; add it by new_columns='add'")
    kinds = dict(target.dtypes) | {c: source.schema[c].dataType.simpleString() for c in extra}
    null = {c: F.lit(None).cast(kind) for c, kind in kinds.items()}
    wide = target.select(*target.columns, *(null[c].alias(c) for c in extra))
    here = set(source.columns)
    return wide, source.select(*((F.col(c) if c in here else null[c]).cast(kinds[c]).alias(c) for c in wide.columns))


def upsert(target: DataFrame, source: DataFrame, key: str = "id", new_columns: str = "fail") -> DataFrame:
    """Target after a merge: matched rows take every column of the source, nulls included;
    source rows without a match are added; nothing is deleted.

    The source must hold each key once (see :func:`latest_version`); a null key matches nothing
    and is added. A column that only the source has is an error, or added (see :func:`fitted`).

    One full outer join, so target and source are evaluated once each.
    """
    old, new = fitted(target, source, new_columns)
    return _merged(old, new, key, "__new", "__old")


def insert_if_absent(
    target: DataFrame, source: DataFrame, key: str = "id", order: Sequence[str] = (), new_columns: str = "fail"
) -> DataFrame:
    """Target plus one source row of each key that it lacks; rows already there stay as they are.

    Of several source rows of a new key the first by ``order`` is added, nulls last, then the one with the smallest other
    columns. A null key meets none, so all such rows are added. Target and source are evaluated once each.
    """
    old, new = fitted(target, source, new_columns)
    return _merged(old, first_version(new, key, order), key, "__old", "__new")


def first_version(source: DataFrame, key: str, order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, nulls last, then by the other columns; rows with a null key all stay.

    Combined before the shuffle, like :func:`latest_version`.
    """
    rest = [c for c in source.columns if c not in (key, *order)]
    places = [part for c in order for part in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    # Rows without a key are told apart by what they hold; those alike in everything are counted and come back.
    grouped = source.groupBy(key, F.when(F.col(key).isNull(), F.struct(*source.columns)).alias("__same"))
    first = F.min(F.struct(*places, *rest, F.lit(0).alias("__end"))).alias("__first")
    picked = grouped.agg(first, F.count(F.lit(1)).alias("__rows"))
    copies = F.when(F.col(key).isNull(), F.col("__rows")).otherwise(F.lit(1))
    each = picked.select(key, "__first", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("__copy"))
    return each.select(*(F.col(key) if c == key else F.col(f"__first.{c}").alias(c) for c in source.columns))


def _spread(key: str, columns: Sequence[str]) -> Column:
    """What tells rows with a null key apart, so that they neither meet nor gather in one task; 0 for all others."""
    return F.when(F.col(key).isNull(), F.xxhash64(*columns)).otherwise(F.lit(0))


def _merged(old: DataFrame, new: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Rows of both sides, matched by key; ``first`` and ``second`` say which side's row a match takes."""
    columns = old.columns
    spread = F.pmod(_spread(key, columns), F.lit(1 << 20))
    left = old.select(F.struct(*columns).alias("__old"), F.col(key).alias("__old_key"), spread.alias("__old_spread"))
    right = new.select(F.struct(*columns).alias("__new"), F.col(key).alias("__new_key"), spread.alias("__new_spread"))
    same = (F.col("__old_key") == F.col("__new_key")) & (F.col("__old_spread") == F.col("__new_spread"))
    merged = left.join(right, same, "full").select(F.coalesce(first, second).alias("__row"))
    return merged.select(*(F.col(f"__row.{c}").alias(c) for c in columns))
