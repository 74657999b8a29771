"""Copies of source tables, kept up to date by key.

A copy lies in buckets of its key's hash (see :mod:`daybook.sinks.buckets`). An update reads and writes only the buckets
that its rows fall in, and splits those that outgrow their target; the commit names, for each bucket, the attempt that
wrote it last.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.upsert import fitted, latest_version, split_null_keys, upsert
from daybook.sinks.buckets import BUCKET, Directory, rows_per_bucket, write_buckets, written_sizes
from daybook.sinks.versions import attempt_path, commit_version, latest_commit, new_attempt, refuse_committed

REPORT = "table_name string, action string, error string"
#: Bytes that a bucket may have before it splits: what one task reads, merges and writes.
BUCKET_BYTES = 256 << 20
_STATE = "__state"


class CopiesFailed(Exception):
    """Some tables were not copied; ``report`` has a row ``table_name, action, error`` for each table."""

    def __init__(self, report: list[tuple[str, str, str | None]]):
        self.report = report
        super().__init__("; ".join(f"{name}: {error}" for name, _, error in report if error))


def read_copy(spark: SparkSession, root: str) -> DataFrame:
    """The copy as of its latest commit."""
    last = latest_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing committed under {root}")
    return _read_buckets(spark, root, last, sorted(last.parts))


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """The rows without a key of all committed versions, with the columns of the latest."""
    last = latest_commit(spark, root)
    if last is None:
        raise FileNotFoundError(f"nothing committed under {root}")
    layout = json.loads(last.layout)
    schema = T.StructType.fromJson(layout["schema"])
    paths = [f"{attempt_path(root, a)}/batch/{_STATE}=rejected" for a in layout["rejected"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _read_buckets(spark: SparkSession, root: str, commit: Row, buckets: Sequence[int]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(commit.layout)["schema"])
    paths = [f"{attempt_path(root, commit.parts[b])}/rows/{BUCKET}={b}" for b in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _staged_batch(source: DataFrame, path: str, key: str, order: Sequence[str]) -> DataFrame:
    """The batch, evaluated and written once: a row a key, and apart from those the rows without one."""
    spark = source.sparkSession
    state = F.when(F.col(key).isNull(), "rejected").otherwise("accepted")
    source.withColumn(_STATE, state).write.mode("errorifexists").option("compression", "zstd").partitionBy(_STATE).parquet(path)
    # As written, with or without rows of either kind.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in source.schema])
    written = spark.read.schema(T.StructType([*schema, T.StructField(_STATE, T.StringType())])).parquet(path)
    keyed = written.filter(F.col(_STATE) == "accepted").drop(_STATE)
    if order:
        return latest_version(keyed, key, order)
    _require_one_row_per_key(keyed, key)
    return keyed


def upsert_copy(
    spark: SparkSession,
    source: DataFrame,
    root: str,
    version: str,
    key: str = "id",
    order: Sequence[str] = (),
    new_columns: str = "fail",
    bucket_bytes: int = BUCKET_BYTES,
) -> str:
    """Bring the copy under ``root`` up to date with ``source``, under a label not used before; returns what was done.

    Rows with a null key cannot be placed by later calls either: they are kept apart, in the version's own folder (see
    :func:`read_rejected`). ``order`` names the columns that tell the newest of several source rows of a key; without it
    the source must hold each key once. ``new_columns`` says what a column means that the copy lacks (see
    :func:`daybook.operators.upsert.fitted`). A bucket that would hold more than ``bucket_bytes`` splits as it is written; the
    others stay, and keep their files unless the batch has rows for them.
    """
    refuse_committed(spark, root, version)
    attempt = new_attempt(version)
    path = attempt_path(root, attempt)
    last = latest_commit(spark, root)
    if last:  # before anything is written
        fitted(_read_buckets(spark, root, last, []), source, new_columns)
    batch = _staged_batch(source, f"{path}/batch", key, order)
    staged = written_sizes(spark, f"{path}/batch", _STATE)
    batch_bytes = staged.get("accepted", 0)
    parts = dict(last.parts) if last else {}
    rejected = json.loads(last.layout)["rejected"] if last else []
    if last:
        known = Directory({int(b): size for b, size in json.loads(last.layout)["sizes"].items()})
    else:
        known = Directory.of_bytes(batch_bytes, bucket_bytes)
    counts = rows_per_bucket(batch, known, (key,))
    share = batch_bytes / max(1, sum(counts.values()))
    # At the bytes of rows of the batch, as if all of them were new.
    expected = {b: (known.sizes[b] if last else 0) + round(n * share) for b, n in counts.items()}
    directory = known.split(expected if last else {}, bucket_bytes)
    if last:
        old = _read_buckets(spark, root, last, sorted(b for b in counts if b in parts))
        schema = fitted(old, batch, new_columns)[0].schema
        merged = upsert(old, batch, key, new_columns)
    else:
        merged, schema = batch, batch.schema
    written = directory.expected(expected)
    write_buckets(merged, directory, (key,), written, f"{path}/rows")
    found = {int(b): size for b, size in written_sizes(spark, f"{path}/rows").items()}
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    layout = {
        "schema": nullable.jsonValue(),
        "sizes": dict(directory.measured(written, found).sizes),
        "rejected": rejected + [attempt] * ("rejected" in staged),
    }
    parts = {b: a for b, a in parts.items() if b not in counts} | dict.fromkeys(found, attempt)
    commit_version(spark, root, version, attempt, parts, json.dumps(layout))
    return "merged" if last else "created"


def _require_one_row_per_key(source: DataFrame, key: str) -> None:
    repeated = source.groupBy(key).count().filter(F.col("count") > 1).limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"several source rows share a value of {key}; name the columns that order them")


def copy_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    lake: str,
    version: str,
    key: str = "id",
    orders: Mapping[str, Sequence[str]] | None = None,
    new_columns: str = "fail",
) -> DataFrame:
    """Copy or merge every table into ``<lake>/<table>``; rows ``table_name, action, error``.

    ``orders`` has the ordering columns of tables that may hold a key several times. A table that fails does not
    stop the others; if any did, :class:`CopiesFailed` is raised after the last.
    """

    def copy(name: str) -> str:
        order = (orders or {}).get(name, ())
        return upsert_copy(spark, tables[name], f"{lake.rstrip('/')}/{name}", version, key, order, new_columns)

    return _each(spark, tables, copy)


def copy_to_catalog(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    namespace: str,
    provider: str = "iceberg",
    key: str = "id",
    orders: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Create or merge every table as ``<namespace>.<table>`` of the catalog; reports and fails like :func:`copy_tables`.

    Null keys are left out: no later merge could place them.
    """

    def copy(name: str) -> str:
        keyed, _ = split_null_keys(tables[name], key)
        if order := (orders or {}).get(name, ()):
            keyed = latest_version(keyed, key, order)
        else:
            _require_one_row_per_key(keyed, key)
        table = f"{namespace}.{name}"
        if spark.catalog.tableExists(table):
            merge_copy(keyed, table, key)
            return "merged"
        create_copy(keyed, table, provider, key)
        return "created"

    return _each(spark, tables, copy)


def _each(spark: SparkSession, tables: Mapping[str, DataFrame], copy: Callable[[str], str]) -> DataFrame:
    report: list[tuple[str, str, str | None]] = []
    for name in tables:
        try:
            report.append((name, copy(name), None))
        except Exception as error:  # noqa: BLE001 - isolation between tables is the point
            report.append((name, "failed", f"{type(error).__name__}: {error}"))
    if any(error for _, _, error in report):
        raise CopiesFailed(report)
    return spark.createDataFrame(report, REPORT)


def create_copy(source: DataFrame, table: str, provider: str = "iceberg", key: str = "id") -> None:
    """Create a catalog table from a frame, as zstd Parquet; a lakehouse format also gets its key declared."""
    writer = source.writeTo(table).using(provider)
    if provider == "parquet":
        writer.option("compression", "zstd").create()
        return
    properties = {"write.parquet.compression-codec": "zstd", "format-version": "2", "identifier-fields": key}
    for name, value in properties.items():
        writer = writer.tableProperty(name, value)
    writer.create()


def merge_copy(source: DataFrame, table: str, key: str = "id") -> None:
    """Merge a frame into a catalog table whose format supports row-level changes.

    Such a table rewrites the files a change touches; :func:`upsert_copy` is for plain Parquet.
    """
    same = F.col(f"{table}.{key}") == F.col(f"source.{key}")
    values = {c: F.col(f"source.{c}") for c in source.columns}
    changed = {c: v for c, v in values.items() if c != key}
    (
        source.alias("source")
        .mergeInto(table, same)
        .whenMatched()
        .update(changed)
        .whenNotMatched()
        .insert(values)
        .merge()
    )
