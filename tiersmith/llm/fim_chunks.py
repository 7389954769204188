"""Fill-in-the-middle documents, cut by code points that are counted once per content-defined chunk.

A rolling hash of the last 16 bytes cuts texts into chunks, so passages that documents share become the same chunks
wherever they stand. A worker keeps a *summary* of each chunk it has met, under the
chunk's bytes, so an entry is used only for equal content: its code points, whether it holds a
marker, and its first and last characters. Summaries combine: counts add up to the length of the text, the
characters at a boundary tell of a marker that lies across it. The running counts tell which chunk holds
a cut; only that chunk is looked into.

``h1`` to ``h4`` are the first four groups of eight digits of the SHA-256 of ``seed:doc_id``: the two
cuts, whether a document is rearranged, and which way. Every row is worked on by itself, nothing is
shuffled. The cache is emptied once it holds ``CACHE_BYTES``.

Defined cases: a null text is an empty one, and an empty text is plain, as is a text that holds a marker; a
null ``doc_id`` counts as an empty string in the hash; rows that repeat are rearranged alike.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm import textbytes as tb

RATE, SUFFIX_FIRST, SEED = 90, 20, 1
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# A chunk has 512 bytes on average, at least LEAST and at most MOST and the rest of a character.
CHUNK_BITS, LEAST, MOST = 9, 64, 4096
CACHE_BYTES = 64 << 20
GEAR = (tb.splitmix(256, 12) >> np.uint64(32)).astype(np.uint32)


def rolling(buf: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes that end at each position, built by doubling the window."""
    h = GEAR[buf]
    for width in (1, 2, 4, 8):
        h[width:] += h[:-width] << np.uint32(width)
    return h


def candidates(buf: np.ndarray) -> list[int]:
    """Where a chunk may end: behind a window whose hash has CHUNK_BITS zeros, in front of a character."""
    if len(buf) < 2:
        return []
    # The top bits depend on all of the window.
    behind = np.flatnonzero(rolling(buf)[:-1] >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    return behind[(buf[behind] & 0xC0) != 0x80].tolist()


def chunk_ends(raw: bytes, ends: list[int], begin: int, end: int) -> Iterator[int]:
    """Ends of the chunks of ``raw[begin:end]``, given the candidates of all of ``raw``."""
    at = begin
    while at < end:
        k = bisect_left(ends, at + LEAST)
        at = min(ends[k] if k < len(ends) else end, at + MOST, end)
        while at < end and raw[at] & 0xC0 == 0x80:  # only behind a longest chunk
            at += 1
        yield at


class Summary(NamedTuple):
    """What a stretch of text contributes: its code points, whether it holds a marker, its two ends."""

    points: int
    marked: bool
    head: str
    tail: str


class Memo:
    """Summaries by content."""

    def __init__(self, markers: tuple[str, ...], limit: int = CACHE_BYTES):
        self.markers, self.limit = markers, limit
        self.reach = max(map(len, markers)) - 1
        if 4 * self.reach > LEAST:
            raise ValueError(f"a marker may have {LEAST // 4 + 1} characters at most")
        self.known: dict[bytes, Summary] = {}
        self.held = self.hits = self.asked = 0

    def summary(self, chunk: bytes) -> Summary:
        self.asked += 1
        found = self.known.get(chunk)  # the dictionary compares the bytes
        if found is None:
            text = chunk.decode()
            found = Summary(len(text), any(m in text for m in self.markers), text[: self.reach], text[-self.reach :])
            if self.held > self.limit:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk) + 200
        else:
            self.hits += 1
        return found

    def joined(self, parts: list[Summary]) -> tuple[list[int], bool]:
        """Code points up to the end of each part, and whether the whole holds a marker.

        Only the last chunk of a text may be shorter than a marker, so one lies across two parts at most.
        """
        across = (a.tail + b.head for a, b in zip(parts, parts[1:]))
        marked = any(p.marked for p in parts) or any(m in both for both in across for m in self.markers)
        return list(accumulate(p.points for p in parts)), marked


def draws(doc_id: int | None, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def rearranged(
    docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, seed: int = SEED,
    markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of each document.

    Of 100 documents ``rate`` are rearranged, of 100 of these ``suffix_first`` with the suffix first.
    """
    p_mark, s_mark, m_mark = (m.encode() for m in markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(markers)

        def document(raw: bytes, ends: list[int], begin: int, end: int, doc_id: int | None):
            stops = list(chunk_ends(raw, ends, begin, end))
            starts = [begin, *stops[:-1]]
            until, marked = memo.joined([memo.summary(raw[a:b]) for a, b in zip(starts, stops)])
            n = until[-1] if until else 0
            h1, h2, h3, h4 = draws(doc_id, seed)
            if n == 0 or marked or h3 % 100 >= rate:
                return n, "plain", None, None, raw[begin:end]

            def byte_of(point: int) -> int:
                """Where in ``raw`` so many code points of the document end."""
                k = bisect_right(until, point)
                if k == len(until):
                    return end
                inside = point - (until[k - 1] if k else 0)
                return starts[k] + len(raw[starts[k] : stops[k]].decode()[:inside].encode())

            a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
            x, y = byte_of(a), byte_of(b)
            prefix, middle, suffix = raw[begin:x], raw[x:y], raw[y:end]
            if h4 % 100 < suffix_first:
                return n, "spm", a, b - a, b"".join((s_mark, suffix, p_mark, prefix, m_mark, middle))
            return n, "psm", a, b - a, b"".join((p_mark, prefix, s_mark, suffix, m_mark, middle))

        for batch in batches:
            for a, b, buf, off in tb.texts(batch):
                raw, ends, at = buf.tobytes(), candidates(buf), off.tolist()
                ids = batch.column("doc_id").slice(a, b - a)
                rows = [document(raw, ends, x, y, i) for x, y, i in zip(at, at[1:], ids.to_pylist())]
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def original(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``output`` was made of, from the output and its form alone.

    No part holds a marker, so the first one found is the one that was put in.
    """
    p_mark, s_mark, m_mark = markers

    def between(left: str, right: str | None) -> Column:
        begin = F.instr(output, left) + F.lit(len(left))
        size = F.instr(output, right) - begin if right else F.length(output)
        return F.substr(output, begin, size)

    psm = F.concat(between(p_mark, s_mark), between(m_mark, None), between(s_mark, m_mark))
    spm = F.concat(between(p_mark, m_mark), between(m_mark, None), between(s_mark, p_mark))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, **options) -> DataFrame:
    """The rows with the SHA-256 of the output and of the text restored from it."""
    return rearranged(docs, **options).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(original(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


DIGEST_SQL = f"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), numbers AS (
  SELECT doc_id, t, n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
    CASE WHEN n = 0 OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
           OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= {RATE} THEN 'plain'
         WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT doc_id, t, n, form, least(x, y) AS a, greatest(x, y) AS b,
    substring(t, 1, least(x, y)) AS p, substring(t, least(x, y) + 1, greatest(x, y) - least(x, y)) AS m, substring(t, greatest(x, y) + 1) AS s
  FROM numbers
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m
    ELSE '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""
