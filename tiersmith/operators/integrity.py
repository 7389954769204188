"""Key, reference and value checks, and what a delete does to child rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference is set but has no parent row."""
    parents = parent.select(F.col(key).alias(foreign_key))
    return child.filter(F.col(foreign_key).isNotNull()).join(parents, foreign_key, "left_anti")


def cascade_delete(child: DataFrame, foreign_key: str, deleted: DataFrame, key: str) -> DataFrame:
    """Child rows that remain when the given parents are deleted."""
    return child.join(deleted.select(F.col(key).alias(foreign_key)).distinct(), foreign_key, "left_anti")


def set_null_delete(child: DataFrame, foreign_key: str, deleted: DataFrame, key: str) -> DataFrame:
    """All child rows, with the reference nulled where the parent is deleted."""
    gone = deleted.select(F.col(key).alias(foreign_key), F.lit(True).alias("_gone")).distinct()
    kept = F.when(F.col("_gone").isNull(), F.col(foreign_key)).alias(foreign_key)
    joined = child.join(gone, foreign_key, "left")
    return joined.select(*[kept if c == foreign_key else F.col(c) for c in child.columns])
