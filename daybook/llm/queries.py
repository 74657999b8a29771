"""One named query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import ann, divergence, fim, hmm, licences, linededup, mixing, mtree, packing, sharding, simhash
from daybook.llm import quality as quality_model
from daybook.llm import toxicity as toxicity_model

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, folder, "embeddings"))


def op2_highest_products(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.highest_products(table(spark, folder, "embeddings"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_model.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.language_model(table(spark, folder, "documents"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


def op8_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.cleaned(table(spark, folder, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "text", "lines", "removed")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, folder, "documents")))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(table(spark, folder, "documents"))


def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(table(spark, folder, "documents")))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


def op13_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"))


def llm_queries() -> dict[str, Query]:
    numbered = (
        op1_nearest_neighbours,
        op2_highest_products,
        op3_simhash,
        op4_toxicity,
        op5_language_model,
        op6_quality,
        op7_mixing,
        op8_lines,
        op9_packing,
        op10_sharding,
        op11_fill_in_middle,
        op12_source_divergence,
        op13_licences,
    )
    return {f.__name__: f for f in numbered}
