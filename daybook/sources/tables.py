"""Named tables, each opened once and only when asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class TableSet(Mapping[str, DataFrame]):
    """Mapping of table name to DataFrame.

    Opening a table reads no data: the memo keeps logical plans, so a table used by
    several builders is resolved against the catalog (or its Parquet footer) only once.
    """

    def __init__(self, open_table: Callable[[str], DataFrame], list_names: Callable[[], list[str]]):
        self._open = open_table
        self._list = list_names
        self._plans: dict[str, DataFrame] = {}

    @classmethod
    def from_directory(cls, spark: SparkSession, directory: str) -> TableSet:
        """One ``<name>.parquet`` file or folder per table."""
        return cls(
            lambda name: spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet"),
            lambda: parquet_names(spark, directory),
        )

    @classmethod
    def from_database(cls, spark: SparkSession, database: str) -> TableSet:
        """All tables of a catalog database."""
        return cls(
            lambda name: spark.table(f"{database}.{name}"),
            lambda: sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary),
        )

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> TableSet:
        return cls(lambda name: frames[name], lambda: sorted(frames))

    def checked(self, schemas: Mapping[str, str]) -> TableSet:
        """The same tables, refused on opening where they do not fit their declared schema (DDL text)."""

        def open_checked(name: str) -> DataFrame:
            df = self[name]
            return require_schema(df, StructType.fromDDL(schemas[name]), name) if name in schemas else df

        return TableSet(open_checked, self._list)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._plans:
            self._plans[name] = self._open(name)
        return self._plans[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._list())

    def __len__(self) -> int:
        return len(self._list())


def parquet_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of the Parquet tables lying directly in a directory of any Hadoop file system."""
    suffix = ".parquet"
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    entries = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = (entry.getPath().getName() for entry in entries)
    return sorted(name[: -len(suffix)] for name in names if name.endswith(suffix))


def require_schema(df: DataFrame, expected: StructType, name: str) -> DataFrame:
    """Fail while planning, not hours into the job, when a source lacks a column or changed its type."""
    actual = {field.name: field.dataType for field in df.schema}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {actual[field.name].simpleString() if field.name in actual else 'nothing'}"
        for field in expected
        if actual.get(field.name) != field.dataType
    ]
    if problems:
        raise ValueError(f"source {name} does not fit its declared schema: {'; '.join(problems)}")
    return df.select(*expected.fieldNames())
