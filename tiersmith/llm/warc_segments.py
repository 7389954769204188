"""WARC archives with segmented records: written by Spark's text writer, read back and reassembled.

A page is an HTTP response with a chunked body. Of pages with equal payloads of ``MIN_REVISIT_BYTES`` or more the
one with the least ``page_id`` is a ``response`` record, the others are ``revisit`` records that refer
to it. A block over ``SEGMENT_BYTES`` is cut: the first segment carries number 1, each further one is a
``continuation`` record with the origin's id and its number, the last also the total length.

Reading parses each archive, groups the segments by origin, orders them by number, checks that none
is missing and that the total length holds, and takes the chunks apart. Only segmented records are
shuffled. Spark reads and writes the files, so any file system it knows will do; an archive is read
whole by one task, so ``FILE_RECORDS`` bounds it.

Defined cases: a null payload is empty, a null url has no target header, a null page id no page
header (and such a page never is what others refer to). Every row is a record of its own, also where
page and payload repeat; only rows that repeat a page that revisits refer to share the record id that
these name, and ``Row-ID``, a number that all segments of a row carry, keeps them apart. A record with
missing segments or a wrong length has ``complete`` false.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.llm.scratch import stored
from tiersmith.session import scratch_dir

SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
MIN_REVISIT_BYTES = 100
FILE_RECORDS = 4000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to, referred``: the page that a revisit refers to, else null; whether revisits refer to this one."""
    base = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    # One row per payload that several pages have.
    first = (
        base.where(F.octet_length("payload") >= min_bytes)
        .groupBy(F.col("digest").alias("d"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1 AND first IS NOT NULL")
    )
    marked = base.join(first, F.col("digest") == F.col("d"), "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    referred = F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    return marked.select("page_id", "url", "payload", "digest", refers.alias("refers_to"), referred.alias("referred"))


def record_id(*of: Column) -> Column:
    """An id from page and payload, and from the row's number where no other record has to know it."""
    h = F.sha2(F.concat_ws("/", *(F.coalesce(c.cast("string"), F.lit("")) for c in of)), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(marked: DataFrame, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES) -> DataFrame:
    """The text of every record, one row per segment, without the two line ends behind it."""
    size = "octet_length(payload)"
    framed = (
        f"concat(if({size} = 0, '', array_join(transform(sequence(0, cast(greatest({size} - 1, 0) div {chunk} AS int)), i -> concat("
        f"lower(hex(least({chunk}, {size} - i * {chunk}))), '\\r\\n', cast(substring(payload, i * {chunk} + 1, {chunk}) AS string), '\\r\\n')), '')),"
        f" '0\\r\\n\\r\\n')"
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit(HTTP_HEAD + "\r\n")).otherwise(
        F.concat(F.lit(HTTP_HEAD + "Transfer-Encoding: chunked\r\n\r\n"), F.expr(framed))
    )
    # The number is drawn once a row, before the row is cut, in the task that writes all of its segments.
    own = F.when(F.col("referred"), record_id(F.col("page_id"), F.col("digest"))).otherwise(record_id(F.col("page_id"), F.col("digest"), F.col("row")))
    rows = marked.withColumn("row", F.monotonically_increasing_id()).select(
        "page_id", "url", "digest", "refers_to", "row", own.alias("id"), block.cast("binary").alias("block")
    )
    count = f"cast(greatest(octet_length(block) - 1, 0) div {segment} AS int)"
    rows = rows.withColumn("last", F.expr(count)).withColumn("k", F.explode(F.expr(f"sequence(0, {count})")))
    part = F.expr(f"substring(block, k * {segment} + 1, {segment})")
    later, cut = F.col("k") > 0, F.col("last") > 0

    def header(name: str, value: Column, when: Column | None = None) -> Column:
        line = F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
        return F.coalesce(line if when is None else F.when(when, line), F.lit(""))

    kind = F.when(later, "continuation").when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    target = F.regexp_replace("url", r"[\r\n]", "%0A")
    own_id = F.when(later, F.regexp_replace("id", ">$", F.concat(F.lit("-"), F.col("k").cast("string"), F.lit(">")))).otherwise(F.col("id"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        header("WARC-Type", kind),
        header("WARC-Record-ID", own_id),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", target),
        header("Page-ID", F.col("page_id")),
        header("Row-ID", F.col("row"), cut),
        header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")), ~later),
        header("WARC-Profile", F.lit(PROFILE), ~later & F.col("refers_to").isNotNull()),
        header("WARC-Refers-To", record_id(F.col("refers_to"), F.col("digest")), ~later & F.col("refers_to").isNotNull()),
        header("WARC-Segment-Number", F.col("k") + 1, cut),
        header("WARC-Segment-Origin-ID", F.col("id"), later),
        header("WARC-Segment-Total-Length", F.expr("octet_length(block)"), cut & (F.col("k") == F.col("last"))),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(part)),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, part.cast("string")).alias("value"))


def write(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES, chunk: int = CHUNK_BYTES, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Archives of all pages (``page_id, url, html``) in a new folder, as gzip files."""
    rows = records(with_revisits(pages, min_bytes), segment, chunk)
    # Each record ends with two line ends, which the writer puts behind it.
    rows.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


PARSED = "record_id string, record_type string, page_id long, row long, segment int, origin string, total long, digest string, refers_to string, block binary"
PARSED_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("row", pa.int64()), ("segment", pa.int32()), ("origin", pa.string()),
    ("total", pa.int64()), ("digest", pa.string()), ("refers_to", pa.string()), ("block", pa.binary()),
])


DECODED = f"{PARSED}, payload binary, payload_bytes long, payload_sum string"
DECODED_ARROW = pa.schema([*PARSED_ARROW, ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sum", pa.string())])


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        h = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(h["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) < size:
            raise ValueError(f"record at byte {at} ends early")
        number = lambda name: int(h[name]) if name in h else None
        yield {
            "record_id": h["warc-record-id"], "record_type": h["warc-type"], "page_id": number("page-id"), "row": number("row-id"),
            "segment": number("warc-segment-number"), "origin": h.get("warc-segment-origin-id"), "total": number("warc-segment-total-length"),
            "digest": h.get("warc-payload-digest", "").removeprefix("sha256:") or None, "refers_to": h.get("warc-refers-to"), "block": block,
        }
        at = end + 4 + size
        while data.startswith(b"\r\n", at):
            at += 2


def read_records(spark: SparkSession, path: str, decode: bool = False, payloads: bool = True) -> DataFrame:
    """All records and segments of the archives in a folder.

    With ``decode``, a record in one piece comes with its payload's length and digest instead of its
    block, and with the payload itself if ``payloads``; segments keep their block.
    """
    schema = DECODED_ARROW if decode else PARSED_ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    data = gunzipped(data)
                held, size = [], 0
                for record in parse(data):
                    if decode and record["segment"] is None:
                        record |= payload_facts(record.pop("block"), payloads)
                    held.append(record)
                    size += 200 + len(record.get("block") or b"") + len(record.get("payload") or b"")
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    archives = spark.read.format("binaryFile").load(path).select("content")
    return archives.mapInArrow(run, DECODED if decode else PARSED)


def payload_facts(block: bytes, payloads: bool) -> dict:
    payload = http_payload(block)
    return {
        "payload": payload if payloads else None, "payload_bytes": len(payload), "payload_sum": hashlib.sha256(payload).hexdigest(),
    }


def gunzipped(data: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while data:
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def put_together(cut: DataFrame) -> DataFrame:
    """One row per segmented record with its whole ``block`` and whether it is ``complete``."""
    head = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    # A segment that is read twice counts once.
    parts = F.array_sort(F.collect_set(F.struct("segment", "block")))
    whole = cut.withColumn("origin", F.coalesce("origin", "record_id")).groupBy("origin", "row").agg(
        *(head(c) for c in ("record_type", "page_id", "digest", "refers_to")), F.max("total").alias("total"), parts.alias("parts"),
    )
    joined = F.expr("cast(array_join(transform(parts, p -> cast(p.block AS string)), '') AS binary)")
    counted = F.expr("transform(parts, p -> p.segment) = sequence(1, greatest(size(parts), 1))")
    fits = counted & (F.coalesce("total", F.lit(-1)) == F.octet_length("block"))
    return whole.withColumn("block", joined).select(
        F.col("origin").alias("record_id"), "record_type", "page_id", "digest", "refers_to", "block", fits.alias("complete")
    )


def reassembled(rows: DataFrame) -> DataFrame:
    """One row per record with its whole ``block`` and whether it is ``complete``."""
    whole = put_together(rows.where("segment IS NOT NULL"))
    return rows.where("segment IS NULL").withColumn("complete", F.lit(True)).select(*whole.columns).unionByName(whole)


def dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk ends early")
        at = end + 4 + size


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body


FOUND = ["record_id", "record_type", "page_id", "refers_to", "digest", "complete", "payload", "payload_bytes", "payload_sum"]


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record: ids, type, whether it is ``complete``, and its own payload, length and digest.

    Records in one piece are decoded where they are parsed; segments are put together first. Without
    ``payloads`` what is parsed is small and written once, so the archives are read once.
    """
    rows = read_records(spark, path, decode=True, payloads=payloads)
    if not payloads:
        rows = stored(rows, "warc-records")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = FOUND[:6]
        none = {"payload": None, "payload_bytes": None, "payload_sum": None}
        for batch in batches:
            facts = [
                payload_facts(block.as_py(), payloads) if complete else none
                for block, complete in zip(batch.column("block"), batch.column("complete").to_pylist())
            ]
            columns = [pa.array([f[c] for f in facts], DECODED_ARROW.field(c).type) for c in FOUND[6:]]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=FOUND)

    shape = (
        "record_id string, record_type string, page_id long, refers_to string, digest string, complete boolean,"
        " payload binary, payload_bytes long, payload_sum string"
    )
    whole = rows.where("segment IS NULL").withColumn("complete", F.lit(True)).select(*FOUND)
    return whole.unionByName(put_together(rows.where("segment IS NOT NULL")).mapInArrow(run, shape))


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives and read back: what each page's record is and its full payload's digest."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), path)
    found = read(spark, path, payloads=False).withColumnRenamed("payload_bytes", "bytes")
    # A revisit's payload is that of the response it refers to.
    own = found.where("record_type <> 'revisit'")
    sent = own.select(F.col("record_id").alias("r"), F.col("page_id").alias("of"), F.col("bytes").alias("b"), F.col("payload_sum").alias("s")).dropDuplicates(["r"])
    again = found.where("record_type = 'revisit'").join(sent, F.col("refers_to") == F.col("r"), "left")
    again = again.select("page_id", F.col("b").alias("payload_bytes"), F.col("s").alias("payload_digest"), "record_type", F.col("of").alias("refers_to"))
    first = own.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("payload_sum").alias("payload_digest"), "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    return first.unionByName(again)


ROUND_TRIP_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
