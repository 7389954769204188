"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tiersmith.llm import (
    bayes_join,
    cgk,
    curve_packing,
    feistel_pii,
    fim_chunks,
    hilbert_shards,
    html_model,
    line_bloom,
    repetition,
    rotated_clusters,
    token_files,
    url_filter,
    warc_segments,
)

# The key of the registered query; a caller passes a secret one.
PSEUDONYM_KEY = "registered-query"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(pages(spark, sf_dir).select("page_id", "url")).drop("url")


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.assign(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.verdicts(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_bloom.digests(documents(spark, sf_dir))


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_pii.pseudonymised(documents(spark, sf_dir).select("doc_id", "text"), PSEUDONYM_KEY)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_segments.round_trip(pages(spark, sf_dir))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_model.extract(pages(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bayes_join.classes(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return cgk.matches(documents(spark, sf_dir), benchmark)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.digests(documents(spark, sf_dir))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotated_clusters.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_chunks.digests(documents(spark, sf_dir))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(documents(spark, sf_dir))


OPERATORS = (
    op1_url_filter, op2_hilbert_shards, op3_quality_rules, op4_line_dedup, op5_pseudonyms, op6_warc, op7_html_text,
    op8_jaccard_join, op9_decontamination, op10_packing, op11_centroid_clusters, op12_fill_in_middle, op13_token_files,
)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in OPERATORS}
# The other operators have no SQL: a trained model, a checksum, a random walk or a tokenizer decides.
ORACLES: dict[str, str] = {
    "op4_line_dedup": line_bloom.DIGEST_SQL,
    "op6_warc": warc_segments.ROUND_TRIP_SQL,
    "op11_centroid_clusters": rotated_clusters.cluster_sql(),
    "op12_fill_in_middle": fim_chunks.DIGEST_SQL,
}
