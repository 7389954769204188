"""Line deduplication with two Bloom filters, so that only suspected repeats are shuffled.

Every task notes the keys of its lines in two bitmaps: *once* when a key is new to the task, *twice*
when its bits were there already. Merging tasks ORs the bitmaps and adds to *twice* what two tasks
have in common, so a key seen in two documents is always in the merged *twice*. That bitmap has a
fixed size (``FILTER_BITS``), whatever the input; it alone is broadcast. Lines it does not know are
unique and never leave their task. For the others a SHA-256 of the key is shuffled with the document
id, the exact count decides, and false alarms of the filter drop out. A fuller filter means more
suspects to shuffle, never another result.

Defined cases: a null or empty text is one empty line; lines of rows without ``doc_id`` neither count
nor go; rows that repeat a ``doc_id`` count as one document; of a dropped key all lines stay in the
largest ``doc_id``; a text without dropped lines stays byte for byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.llm.scratch import stored

MIN_CHARS = 40
MIN_DOCS = 5
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
# 16 MB a bitmap: a task holds two, the broadcast is one. At two probes a key, some 10 % of unknown
# keys are suspected by mistake with 25 million keys seen twice.
FILTER_BITS = 1 << 27
CHUNKS = 64
PROBES = 2


def line_key(line: str) -> str:
    """The line without outer white space and with A-Z in lower case."""
    return line.strip(WHITE).encode().lower().decode()


def long_keys(text: str | None, min_chars: int) -> Iterator[tuple[str, bytes | None]]:
    """Every line of a text with its key in UTF-8, None for a key too short to count."""
    for line in (text or "").split("\n"):
        inner = line.strip(WHITE)
        yield line, inner.encode().lower() if len(inner) >= min_chars else None


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    probes = [(hashes + np.uint64(i) * step * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11) for i in range(PROBES)]
    return np.stack(probes).astype(np.int64) & (bits - 1)


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(bitmap, flat >> 3, (1 << (flat & 7)).astype(np.uint8))


def _document_hashes(batch: pa.RecordBatch, min_chars: int) -> np.ndarray:
    """A 64-bit hash of each distinct long key of each document of a batch."""
    out: list[int] = []
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
        if doc_id is not None:
            out.extend({xxhash.xxh3_64_intdigest(k) for _, k in long_keys(text.as_py(), min_chars) if k is not None})
    return np.array(out, dtype=np.uint64)


def seen_twice(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS) -> bytes:
    """The merged bitmap of keys that more than one document may hold."""
    width = bits // 8 // CHUNKS

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            hashes, n = np.unique(_document_hashes(batch, min_chars), return_counts=True)
            at = _bits(hashes, bits)
            known = _has(once, at) | (n > 1)
            _set(twice, at[:, known])
            _set(once, at)
        for i in range(CHUNKS):
            a, b = once[i * width : (i + 1) * width], twice[i * width : (i + 1) * width]
            if a.any():
                yield pa.RecordBatch.from_pydict({"chunk": [i], "once": [a.tobytes()], "twice": [b.tobytes()]}, schema=notes)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i, once, twice in zip(*(batch.column(c).to_pylist() for c in ("chunk", "once", "twice"))):
                a, b = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
                if i in have:
                    x, y = have[i]
                    y |= b | (x & a)
                    x |= a
                else:
                    have[i] = (a.copy(), b.copy())
        for i, (x, y) in have.items():
            yield pa.RecordBatch.from_pydict({"chunk": [i], "once": [x.tobytes()], "twice": [y.tobytes()]}, schema=notes)

    notes = pa.schema([("chunk", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
    shape = "chunk int, once binary, twice binary"
    parts = docs.select("doc_id", "text").mapInArrow(note, shape)
    # A merging task streams its chunks and holds CHUNKS of them at most: two bitmaps in all.
    merged = parts.repartition(CHUNKS, "chunk").mapInArrow(merge, shape).select("chunk", "twice")
    whole = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():  # CHUNKS rows, one bitmap in all
        whole[row.chunk * width : (row.chunk + 1) * width] = np.frombuffer(row.twice, np.uint8)
    return whole.tobytes()


def suspects(docs: DataFrame, twice: bytes, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id`` and the digest of each of its keys that the filter knows, once per row."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)
    bits = len(twice) * 8

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            ids, digests = [], []
            owners, keys = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if doc_id is not None:
                    own = {k for _, k in long_keys(text.as_py(), min_chars) if k is not None}
                    keys.extend(own)
                    owners.extend([doc_id] * len(own))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
            for i in np.flatnonzero(_has(bitmap, _bits(hashes, bits))):
                ids.append(owners[i])
                digests.append(hashlib.sha256(keys[i]).digest())
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "digest": digests}, schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, digest binary")


def decisions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = FILTER_BITS) -> DataFrame:
    """Per document that loses lines: ``doc_id`` and the digests of the keys it loses."""
    found = stored(suspects(docs, seen_twice(docs, min_chars, bits), min_chars), "line-suspects").distinct()
    repeated = (
        found.groupBy("digest").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper")).where(F.col("docs") >= min_docs)
    )
    lost = found.join(repeated, "digest").where(F.col("doc_id") != F.col("keeper"))
    return lost.groupBy("doc_id").agg(F.collect_list("digest").alias("digests"))


LINES = T.StructType().add("__n_lines", "long").add("__n_dropped", "long")


def dedupe(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with the lines gone from ``text``, and ``__n_lines`` (before) and ``__n_dropped``."""
    lost = decisions(docs, min_chars, min_docs, bits).select(F.col("doc_id").alias("__id"), F.col("digests").alias("__lost"))
    joined = docs.join(lost, docs["doc_id"].cast("long") == F.col("__id"), "left").drop("__id")
    schema, names = T.StructType([*docs.schema.fields, *LINES.fields]), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, lost in zip(batch.column("text").to_pylist(), batch.column("__lost").to_pylist()):
                n_lines.append((text or "").count("\n") + 1)
                if lost:
                    gone = set(lost)
                    stay = [
                        line for line, key in long_keys(text, min_chars)
                        if key is None or hashlib.sha256(key).digest() not in gone
                    ]
                    n_dropped.append(n_lines[-1] - len(stay))
                    text = "\n".join(stay)
                else:
                    n_dropped.append(0)
                texts.append(text)
            columns = {c: batch.column(c) for c in names}
            columns |= {"text": pa.array(texts, pa.string()), "__n_lines": pa.array(n_lines, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns | {"__n_dropped": pa.array(n_dropped, pa.int64())})

    return joined.mapInArrow(run, schema)


def stage(docs: DataFrame, **options: int) -> DataFrame:
    """Every document with its repeated lines gone; the columns of ``docs``.

    Where lines went, a numeric column ``n_chars`` is set to the code points that stay.
    """
    out = dedupe(docs, **options)
    kinds = dict(docs.dtypes)
    if kinds.get("n_chars") in ("int", "bigint"):
        counted = F.when(F.col("__n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", counted.cast(kinds["n_chars"]))
    return out.select(*docs.columns)


def digests(docs: DataFrame, **options: int) -> DataFrame:
    """``doc_id``, line counts and the SHA-256 of what stays."""
    return dedupe(docs.select("doc_id", "text"), **options).select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


DIGEST_SQL = """
WITH lines AS (
  SELECT d.doc_id, u.i, u.line,
    translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents d,
    LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
                    generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS i) u
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.doc_id, l.i, l.line, r.key IS NOT NULL AND l.doc_id <> r.keeper AS gone
  FROM lines l LEFT JOIN repeated r ON l.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
