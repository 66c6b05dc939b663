"""The corpus pipeline: documents go through the stages below, each written as Parquet and read again.

Every stage but the last returns the columns of ``documents``; the last returns the packed pieces.
SQL cannot express the classifier, the join or the mix, so there is no ORACLE_SQL; tests hold each stage
against a plain version of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestar.llm import exact_dedup, mixing, ngram_join, packing, quality_classifier
from lakestar.llm.scratch import Scratch, reachable


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(quality_classifier.described(docs), labels)
    return quality_classifier.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text, the one with the largest id."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that n-gram Jaccard links connect."""
    return ngram_join.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, packed into sequences."""
    return packing.packed(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    reachable(spark)
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
