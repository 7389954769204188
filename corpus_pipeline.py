"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and reads all that its predecessor kept. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiersmith.llm import bayes_join, cgk, curve_packing, line_bloom, repetition
from tiersmith.llm.scratch import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return repetition.stage(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that five or more documents hold; the last one keeps them."""
    return line_bloom.stage(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return bayes_join.stage(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return cgk.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their ids."""
    return curve_packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

# Walks, posteriors and tokenizers have no SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{k + 1}")
    return docs
