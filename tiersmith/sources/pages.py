"""Landed API pages: one JSON document per page, records under a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.sources.files import flatten


def read_pages(spark: SparkSession, path, schema: T.StructType | str, one_per_line: bool = True) -> DataFrame:
    """Page envelopes. The paging style (offset, page, cursor) only matters to whoever fetched them."""
    return spark.read.option("multiLine", not one_per_line).schema(schema).json(path)


def page_records(pages: DataFrame, results_key: str = "results") -> DataFrame:
    """The records of all pages, without the envelope."""
    return flatten(pages.select(F.explode(results_key).alias("_record")).select("_record.*"))


def completeness(pages: DataFrame, results_key: str = "results", total_key: str = "totalHits") -> DataFrame:
    """Records landed against the total the envelope announces."""
    landed = F.coalesce(F.sum(F.size(results_key)), F.lit(0)).cast("bigint")
    return pages.agg(
        F.count("*").alias("pages"),
        landed.alias("records"),
        F.max(total_key).cast("bigint").alias("announced"),
        F.coalesce(landed >= F.max(total_key), F.lit(False)).alias("complete"),
    )
