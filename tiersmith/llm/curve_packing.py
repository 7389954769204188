"""Packing along a space-filling curve: similar documents share sequences, and hardly a slot stays empty.

A document's token ids are counted into hashed buckets; the log counts, scaled to length one, are
projected to three dimensions and quantised, and their Hilbert index orders all documents. Laid
behind each other in that order, the documents are cut every ``SEQUENCE`` ids, so every sequence but
the very last is full.

Only a narrow table (row, key, number of ids) is range-sorted. The ids are written once and meet
their position in one join; where a row starts comes from a running sum inside each range and the
sums of the ranges before it. Equal keys are ordered by ``doc_id``, so a hot key spreads over ranges.

Defined cases: a null or empty text has the end id alone; rows that repeat a document, or lack an
id, are packed like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.llm import hilbert
from tiersmith.llm import textbytes as tb
from tiersmith.llm.scratch import stored
from tiersmith.llm.tokens import tokenizer

SEQUENCE = 4096
END_ID = 2
BUCKETS = 1024
DIMENSIONS, BITS = 3, 10


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def projection() -> np.ndarray:
    signs = (tb.splitmix(BUCKETS * DIMENSIONS, 10) >> np.uint64(63)).astype(np.float64) * 2 - 1
    return signs.reshape(BUCKETS, DIMENSIONS)


def curve_keys(ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Hilbert key of each document's hashed vector."""
    n = len(off) - 1
    out = np.zeros(n, np.int64)
    plan, bucket = projection(), (tb.mix(ids.astype(np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64)
    for a in range(0, n, 256):
        b = min(n, a + 256)
        owner = np.repeat(np.arange(b - a), np.diff(off[a : b + 1]))
        counts = np.bincount(owner * BUCKETS + bucket[off[a] : off[b]], minlength=(b - a) * BUCKETS)
        # Only buckets in use carry weight.
        used = np.flatnonzero(counts)
        owner, weight = used // BUCKETS, np.log1p(counts[used])
        length = np.sqrt(np.bincount(owner, weight * weight, b - a))
        signs = plan[used % BUCKETS]
        along = np.stack([np.bincount(owner, weight * signs[:, d], b - a) for d in range(DIMENSIONS)], axis=1)
        along = along / np.maximum(length, 1e-12)[:, None]
        place = ((1 + np.tanh(along / 2)) / 2 * (1 << BITS)).astype(np.int64)
        out[a:b] = hilbert.index(np.clip(place, 0, (1 << BITS) - 1), BITS)
    return out


def tokenized(docs: DataFrame, definition: str, end_id: int = END_ID) -> DataFrame:
    """``row, doc_id, key, n, ids`` of each document; ids are 16 bits wide where the vocabulary allows."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(shared.value)
        wide = "<u2" if max(tok.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for a, b, buf, off in tb.texts(batch):
                ids, at = tok.encode(buf, off)
                keys = curve_keys(ids, at)
                small, end = ids.astype(wide), np.array([end_id], wide).tobytes()
                packed = [small[x:y].tobytes() + end for x, y in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(keys), pa.array(np.diff(at) + 1), pa.array(packed, pa.binary())],
                    names=["doc_id", "key", "n", "ids"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, key long, n long, ids binary").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "key", "n", "ids"
    )


def positions(tokens: DataFrame) -> DataFrame:
    """``row`` and the ``place`` of its first id when all rows lie behind each other along the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            until = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.full(len(n), part, np.int64)), pa.array(until - n), pa.array(n)],
                names=["row", "part", "start", "n"],
            )
            at = int(until[-1]) if len(n) else at

    order = ["key", "doc_id", "row"]
    ranged = tokens.select("row", "doc_id", "key", "n").repartitionByRange(*order).sortWithinPartitions(*order)
    local = stored(ranged.mapInArrow(run, "row long, part long, start long, n long"), "curve-order")
    # One row per range.
    sums = local.groupBy("part").agg(F.sum("n").alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select(F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("before"))
    return local.join(offsets, F.col("part") == F.col("p")).select(F.col("row").alias("r"), (F.col("start") + F.col("before")).alias("place"))


def pack(docs: DataFrame, tokenizer_path: str | None = None, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """The pieces: ``doc_id, start, length, doc_tokens, sequence_id, offset`` and ``ids`` (32 bits, little-endian)."""
    definition = Path(tokenizer_path or default_tokenizer()).read_text()
    tokens = stored(tokenized(docs, definition, end_id), "tokens")
    # Both sides are written tables; the merge join is asked for because the positions grow with the
    # documents: broadcasting them while they are few would only hide that.
    placed = tokens.join(positions(tokens).hint("merge"), F.col("row") == F.col("r")).select("doc_id", "n", "ids", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, place = batch.column("n").to_numpy(), batch.column("place").to_numpy()
            first = place // length
            many = (place + n - 1) // length - first + 1
            doc = np.repeat(np.arange(len(n)), many)
            sequence = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + first[doc]
            begin = np.maximum(place[doc], sequence * length)
            end = np.minimum(place[doc] + n[doc], (sequence + 1) * length)
            start = begin - place[doc]
            size = end - begin
            at, data = -1, np.empty(0, np.uint32)
            pieces = []
            for d, s, k in zip(doc, start, size):
                if d != at:
                    raw = batch.column("ids")[int(d)].as_py()
                    at, data = d, np.frombuffer(raw, "<u2" if len(raw) == 2 * n[d] else "<u4").astype("<u4")
                pieces.append(data[s : s + k].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), *(pa.array(x) for x in (start, size, n[doc], sequence, begin - sequence * length)), pa.array(pieces, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return placed.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def digests(docs: DataFrame, **options) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pack(docs, **options).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
