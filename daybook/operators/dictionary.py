"""Lookup tables as key-value items."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import iso_timestamp


def dictionary_items(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Each row of each table as an item: ``id, source_id, source_table, attributes``.

    ``id`` is the table name followed by the row's id. ``attributes`` is a JSON object of the other
    columns; nulls are left out, timestamps are ISO text. Floats appear as their shortest decimal
    text, so a reader that parses JSON numbers as decimals gets exactly what the text shows.
    """
    return reduce(DataFrame.unionByName, (_items(name, df) for name, df in tables.items()))


def dictionary_attributes(items: DataFrame) -> DataFrame:
    """Items in long form: one row ``id, attribute, value`` per value present."""
    values = F.map_concat(
        F.create_map(F.lit("source_id"), "source_id", F.lit("source_table"), "source_table"),
        F.from_json("attributes", "map<string,string>"),
    )
    return items.select("id", F.explode(values).alias("attribute", "value"))


def dictionary_counts(items: DataFrame) -> DataFrame:
    """Items per table."""
    return items.groupBy("source_table").agg(F.count(F.lit(1)).alias("items"))


def _items(name: str, df: DataFrame) -> DataFrame:
    source_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    attributes = [_json_value(f).alias(f.name) for f in df.schema if f.name != "id"]
    return df.select(
        F.concat(F.lit(name), source_id).alias("id"),
        source_id.alias("source_id"),
        F.lit(name).alias("source_table"),
        F.to_json(F.struct(*attributes)).alias("attributes"),
    )


def _json_value(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(field.name)
    return F.col(field.name)
