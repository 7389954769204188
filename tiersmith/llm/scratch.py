"""Tables that cut lineage: written to the shared folder of ``spark.checkpoint.dir``, read again."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tiersmith.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table: later jobs read it and neither recompute nor reshuffle it."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
