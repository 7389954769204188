"""Shards along a Hilbert curve over metadata, so that files can be pruned by several columns at once.

Language, source and text size are quantised to ``BITS`` bits each; the Hilbert index of the three is
the first sort key. Shards are runs of the sorted rows whose counts differ by one at most (law
``rows``), so a shard covers a compact region of all three dimensions.

The order comes from one range-partitioned sort of narrow rows; a row's rank is its place in its
range plus the rows of the ranges before it. The text's checksum and ``doc_id`` follow the curve index
as sort keys: equal texts stand together, and a hot source or copied text still spreads over ranges.

Defined cases: null language or source has a cell of its own, a null text has size 1 and checksum 0;
rows that repeat a document get a slot each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm import hilbert
from tiersmith.llm.scratch import stored

SHARDS = 8
BITS = 8
LAW = "rows"


def coordinates(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32`` and the quantised dimensions ``lang_cell, source_cell, size_cell``."""
    most = (1 << BITS) - 1
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    # Names have no order worth keeping: a checksum spreads them over cells 1 and up, null is cell 0.
    named = {
        f"{c}_cell": F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % most + 1, F.lit(0)).cast("int") for c in ("lang", "source")
    }
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        *(v.alias(k) for k, v in named.items()),
        # Eight steps for each doubling of the size.
        F.least(F.floor(F.log2(size) * 8), F.lit(most)).cast("int").alias("size_cell"),
    )


def ranked(docs: DataFrame) -> DataFrame:
    """All rows with ``curve`` index, ``rank`` from 0 and the ``total`` count."""
    cells = coordinates(docs)
    curve = F.expr(hilbert.index_sql(["lang_cell", "source_cell", "size_cell"], BITS)).alias("curve")
    order = ["curve", "text_crc32", "doc_id"]
    placed = cells.select("doc_id", "size", "text_crc32", curve).repartitionByRange(*order).sortWithinPartitions(*order)
    # The id holds the range in its high bits and the place in the range in the low 33.
    local = stored(placed.withColumn("__id", F.monotonically_increasing_id()), "curve-ranks")
    local = local.withColumn("__range", F.shiftright("__id", 33))
    # One row per range.
    counts = local.groupBy("__range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    ranges = counts.select(
        F.col("__range").alias("__r"), F.coalesce(before, F.lit(0)).alias("__before"), F.sum("n").over(Window.partitionBy()).alias("total")
    )
    rank = F.col("__before") + F.col("__id").bitwiseAND((1 << 33) - 1)
    return local.join(ranges, F.col("__range") == F.col("__r")).select("doc_id", "size", "text_crc32", "curve", rank.alias("rank"), "total")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row with its ``shard`` and its ``slot`` in it."""
    # A shard begins at the first rank with rank * shards >= shard * total.
    first = f"((shard * total + {shards - 1}) div {shards})"
    return (
        ranked(docs)
        .withColumn("shard", F.expr(f"cast(rank * {shards} div total AS int)"))
        .select(
            "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.expr(f"rank - {first}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "curve",
        )
    )
