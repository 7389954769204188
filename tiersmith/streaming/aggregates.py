"""Aggregates kept up to date from a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tiersmith.operators.cleaning import deduplicate
from tiersmith.operators.incremental import Kept, before_and_after
from tiersmith.session import temporary
from tiersmith.sources import paths


def last_changes(spark: SparkSession, log: str, keys: list[str], order: list[str], without: str | None = None) -> DataFrame | None:
    """The last change of each key over all batches of a log, deletes included."""
    names = [n for n in paths.names(spark, log) if n.startswith("batch=") and n != without and paths.exists(spark, f"{log}/{n}/_SUCCESS")]
    return deduplicate(spark.read.parquet(*(f"{log}/{n}" for n in names)), keys, "last", order) if names else None


def take(batch: DataFrame, number: int | str, kept: list[Kept], log: str, keys: list[str], order: list[str], op: str) -> None:
    """A batch of changes into the aggregates and the log; one that is repeated replaces itself in both."""
    spark = batch.sparkSession
    known = last_changes(spark, log, keys, order, f"batch={number}")
    with temporary(spark, "taken") as path:
        # Each aggregate, and the log, read them: what they are is worked out once.
        last = deduplicate(batch, keys, "last", order)
        last.write.parquet(f"{path}/last")
        last = spark.read.schema(last.schema).parquet(f"{path}/last")
        before, after = before_and_after(known, last, keys, order, op, f"{path}/both")
        for aggregate in kept:
            aggregate.apply(before, after, number)
        last.write.mode("overwrite").parquet(f"{log}/batch={number}")


def maintain(
    stream: DataFrame, kept: list[Kept], log: str, keys: list[str], order: list[str], op: str, checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """Keep aggregates up to date from a stream of changes, which are appended to ``log`` as they come."""
    trigger = {"availableNow": True} if drain else {"processingTime": "30 seconds"}
    writer = stream.writeStream.foreachBatch(lambda batch, number: take(batch, number, kept, log, keys, order, op))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
