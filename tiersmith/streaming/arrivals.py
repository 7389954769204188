"""Files that arrive in a folder: each is read once, in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tiersmith.sources import files, quarantine
from tiersmith.sources.bronze import with_source_hash
from tiersmith.sources.landing_table import LandingTable

POLL_INTERVAL = "30 seconds"


def arrivals(
    spark: SparkSession, folder: str, schema: T.StructType, file_format: str = "csv",
    pattern: str | None = None, files_per_batch: int = 1000, archive: str | None = None, corrupt_column: str | None = None,
) -> DataFrame:
    """A stream over new files with their name. ``archive`` moves finished files there.

    With ``corrupt_column``, a column of ``schema``, records that do not fit keep their text in it.
    """
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        reader = reader.option("header", True)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(folder).withColumn("_source_file", F.col("_metadata.file_name"))


def land(
    stream: DataFrame, source_name: str, target: str, checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """Write arrivals to bronze, exactly once per file. ``drain`` stops when all files are read."""
    rows = with_source_hash(stream).withColumns(
        {"_source_name": F.lit(source_name), "_ingested_at": F.current_timestamp()}
    )
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy("_source_name")
    trigger = {"availableNow": True} if drain else {"processingTime": POLL_INTERVAL}
    return writer.trigger(**trigger).start(target)


def land_checked(
    spark: SparkSession, folder: str, schema: T.StructType, dataset: str, source_name: str, root: str, checkpoint: str,
    file_format: str = "csv", drain: bool = False, **options,
) -> StreamingQuery:
    """Arrivals into the dataset's bronze table: rows that cannot be read are set aside, known content is not added.

    Each micro-batch is a batch of the ledger. One that is repeated after a failure lands what is not there yet,
    and the same rows in a file of another name, or after a restart, add nothing.
    """
    full = T.StructType([*schema.fields, T.StructField(files.CORRUPT, T.StringType())])
    header = F.array(*(F.lit(f.name) for f in schema)) if file_format == "csv" else F.lit(None).cast("array<string>")

    def land_batch(batch: DataFrame, number: int) -> None:
        good, bad = files.split_corrupt(files.touched(batch))
        quarantine.set_aside(bad.withColumns({"dataset": F.lit(dataset), "header": header}), root, f"stream-{number}")
        LandingTable(batch.sparkSession, root, dataset).land(good, source_name, F.current_timestamp())

    stream = arrivals(spark, folder, full, file_format, corrupt_column=files.CORRUPT, **options)
    trigger = {"availableNow": True} if drain else {"processingTime": POLL_INTERVAL}
    return stream.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()
