"""Change feed into a table that holds the latest row per key.

Plain Parquet has no MERGE. Each micro-batch appends its own latest row per key to a change log in a
folder of its own (so a replayed batch replaces itself). A batch therefore costs what the batch
holds, not what the table holds. ``compact`` folds the log into a new version of a base and removes
the folded batches; readers take the latest row per key of the base and the batches since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiersmith.operators.cleaning import deduplicate
from tiersmith.sources.store import read_current, write_current

DELETE = "DELETE"


def upsert_batches(stream: DataFrame, keys: list[str], order: list[str], log: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        latest = deduplicate(batch, keys, "last", order)
        latest.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    trigger = {"availableNow": True} if drain else {"processingTime": "30 seconds"}
    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def current_rows(changes: DataFrame, keys: list[str], order: list[str], op: str | None = None) -> DataFrame:
    """Latest row per key; keys whose last change is a delete are gone."""
    latest = deduplicate(changes, keys, "last", order)
    return latest.filter(F.col(op) != DELETE).drop(op) if op else latest


def _batches(spark: SparkSession, log: str) -> list:
    """The finished batch folders of a log."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(log)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    folders = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
    return [f for f in folders if fs.exists(hadoop.Path(f, "_SUCCESS"))]


def read_log(spark: SparkSession, log: str, base: str | None = None) -> DataFrame:
    """All changes a reader needs: the base, if there is one, and the batches since."""
    parts = [str(f) for f in _batches(spark, log)]
    kept = read_current(spark, base) if base else None
    since = spark.read.parquet(*parts) if parts else None
    if kept is None or since is None:
        return kept if since is None else since
    return kept.unionByName(since, allowMissingColumns=True)


def compact(spark: SparkSession, log: str, base: str, keys: list[str], order: list[str]) -> str:
    """Fold the log into a new version of the base.

    Deletes stay in the base as rows, so an older change that arrives late cannot revive a key. If
    removing the folded batches fails, they are merely folded again.
    """
    folded = _batches(spark, log)
    path = write_current(deduplicate(read_log(spark, log, base), keys, "last", order), base)
    for folder in folded:
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return path
