"""Listing of landed objects."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OBJECT = "key string, size bigint, last_modified timestamp"


def inventory(spark: SparkSession, location: str, prefix: str = "") -> DataFrame:
    """Every object under ``location`` whose key begins with ``prefix``: key, size, last change.

    Only the deepest folder the prefix names is listed; a folder that does not exist has no objects.
    The content column of the file source is pruned, so no object is opened. Spark lists folders in
    parallel tasks once there are more than ``spark.sql.sources.parallelPartitionDiscovery.threshold``
    of them. Like all of Spark's file sources it passes over empty objects and names that begin with
    ``_`` or ``.``.
    """
    root = location.rstrip("/")
    folder = prefix.rpartition("/")[0]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.load(f"{root}/{folder}" if folder else root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], OBJECT)
    after_root = F.regexp_replace("path", "^.*?" + _literal(_bare(root)) + "/", "")
    return files.select(
        after_root.alias("key"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    ).filter(F.col("key").startswith(prefix))


def inventory_summary(objects: DataFrame, location: str, prefix: str = "") -> DataFrame:
    """Object count and bytes, beside the listing's location."""
    return objects.agg(
        F.count(F.lit(1)).alias("objects"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    ).select(F.lit(location).alias("location"), F.lit(prefix).alias("prefix"), "objects", "bytes")


def _bare(location: str) -> str:
    """Location without its scheme, as file:/x, file:///x and /x name the same folder."""
    _, found, rest = location.partition(":")
    return "/" + rest.lstrip("/") if found else location


def _literal(text: str) -> str:
    return "\\Q" + text + "\\E"
