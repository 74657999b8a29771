"""Versioned folders: data is written beside the current version and takes effect with one commit.

``<root>/data/<attempt>`` holds what one attempt wrote, ``<root>/commits`` one row per committed version with the
attempt that made it. Every attempt has a folder of its own, so one that fails, or runs again under the same
label, never touches what readers see. A label is committed once. One writer per root at a time: nothing here
arbitrates between two.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# parts: for data in buckets, the attempt that wrote each bucket; layout: schema and sizes as JSON.
_COMMIT = "seq bigint, version string, attempt string, parts map<int,string>, layout string"


class VersionExists(ValueError):
    """The label was committed before; its data stays as it is."""


def new_attempt(version: str) -> str:
    return f"{version}-{uuid.uuid4().hex[:12]}"


def attempt_path(root: str, attempt: str) -> str:
    return f"{root.rstrip('/')}/data/{attempt}"


def refuse_committed(spark: SparkSession, root: str, version: str) -> None:
    if is_committed(spark, root, version):
        raise VersionExists(f"version {version} of {root} is committed; choose another label")


def write_version(df: DataFrame, root: str, version: str, partition_by: Sequence[str] = ()) -> str:
    """Write a version's data, not yet visible to readers; returns the attempt to commit."""
    refuse_committed(df.sparkSession, root, version)
    attempt = new_attempt(version)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    writer.partitionBy(*partition_by).parquet(attempt_path(root, attempt))
    return attempt


def commit_version(
    spark: SparkSession, root: str, version: str, attempt: str, parts: Mapping[int, str] | None = None, layout: str | None = None
) -> None:
    """Make what an attempt wrote the current version."""
    refuse_committed(spark, root, version)
    last = latest_commit(spark, root)
    row = (last.seq + 1 if last else 0, version, attempt, dict(parts) if parts is not None else None, layout)
    spark.createDataFrame([row], _COMMIT).coalesce(1).write.mode("append").parquet(_commits(root))


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version readers see, if any was committed."""
    last = latest_commit(spark, root)
    return last.version if last else None


def current_path(spark: SparkSession, root: str) -> str:
    """The folder of the version readers see."""
    last = latest_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing committed under {root}")
    return attempt_path(root, last.attempt)


def is_committed(spark: SparkSession, root: str, version: str) -> bool:
    commits = _read_commits(spark, root)
    return commits is not None and not commits.filter(F.col("version") == version).isEmpty()


def latest_commit(spark: SparkSession, root: str) -> Row | None:
    commits = _read_commits(spark, root)
    if commits is None:
        return None
    return commits.agg(F.max_by(F.struct(*commits.columns), "seq").alias("c")).select("c.*").first()


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def _read_commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_COMMIT).parquet(_commits(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
