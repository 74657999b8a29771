"""Training text from raw documents: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import linededup, mixing, packing, simhash
from daybook.llm import quality as quality_model
from daybook.llm.common import kept
from daybook.llm.queries import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_model.good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated lines of many sites; ``n_chars`` follows the text."""
    found = linededup.cleaned(docs)
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        row = row.withField("n_chars", F.when(F.col("removed") > 0, F.length("text").cast(kind)).otherwise(F.col("row.n_chars")))
    return found.select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources, in its order; a document of a source with a high target comes more than once."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their windows."""
    return packing.digest(packing.pack(docs))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]
#: Fingerprints and token ids are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
