"""Tables written to the folder that driver and executors share, so that later steps read them instead of recomputing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, as in tests, a new local one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="daybook-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder in the shared one that nothing else uses."""
    return f"{shared_folder(spark)}/daybook/{uuid.uuid4().hex}-{name}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: what follows neither recomputes nor depends on it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
