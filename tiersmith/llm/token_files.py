"""Token ids in binary files: one array of ids a file, document boundaries in Elias-Fano code.

``TokenFiles`` is a Spark data source, ``token_ids``. A file holds, behind each other: a mark, all ids
(2 bytes each where the vocabulary allows, else 4, little-endian), the Elias-Fano codes of the boundaries (one more than
documents) and of the sorted document ids, and a fixed trailer with lengths and
checksums. A task writes its partition, in order, to files of ``FILE_IDS`` ids or one longer document each,
holding one batch at a time. Names carry a number drawn per attempt; the driver lists the files of
successful tasks, with the ids before each, in ``_files.json`` when all tasks are done. Readers see that list
only, so what lost or repeated tasks leave behind is never read. One task reads one file, some
``READ_IDS`` ids at a time, and asks the code's ``select`` where they begin.

The ids are made in the writing task, behind the range shuffle of the texts, so they are stored once.

Any folder that pyarrow knows will do (local and mounted folders, HDFS, object stores).

Defined cases: a null or empty text has the end id alone; rows without ``doc_id`` come first; rows that
repeat a ``doc_id`` are ordered by a hash of their text; no row gives a list without files.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tiersmith.llm import textbytes as tb
from tiersmith.llm.elias_fano import EliasFano
from tiersmith.llm.tokens import tokenizer
from tiersmith.session import scratch_dir

END_ID = 1
FORMAT = "token_ids"
MARK = b"TOKENS01"
# documents, documents without id, ids, bytes an id, bytes of the two codes, CRC-32 of ids and of codes
TRAILER = struct.Struct("<QQQBQQII8s")
LISTING = "_files.json"
FILE_IDS, FILE_DOCS = 1 << 25, 1 << 20
READ_IDS, READ_DOCS = 1 << 18, 1 << 12


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """The files of one task: name, documents, ids, in order."""

    part: int
    files: list[tuple[str, int, int]]


class OneFile:
    """A file under way."""

    def __init__(self, where: fs.FileSystem, folder: str, name: str, width: int):
        self.name, self.width = name, width
        self.out = where.open_output_stream(f"{folder}/{name}")
        self.out.write(MARK)
        self.sizes: list[np.ndarray] = []
        self.doc_ids: list[np.ndarray] = []
        self.docs = self.nulls = self.ids = self.crc = 0

    def add(self, doc_ids: np.ndarray, nulls: int, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents behind those so far; ``doc_ids`` are those of the documents that have one."""
        data = ids.astype(f"<u{self.width}").tobytes()
        self.out.write(data)
        self.crc = zlib.crc32(data, self.crc)
        self.sizes.append(sizes)
        self.doc_ids.append(doc_ids)
        self.docs, self.nulls, self.ids = self.docs + len(sizes), self.nulls + nulls, self.ids + len(ids)

    def close(self) -> tuple[str, int, int]:
        edges = EliasFano.of(np.cumsum(np.concatenate([np.zeros(1, np.int64), *self.sizes]))).to_bytes()
        owners = EliasFano.of(np.concatenate(self.doc_ids)).to_bytes()
        self.out.write(edges)
        self.out.write(owners)
        crc = zlib.crc32(owners, zlib.crc32(edges))
        self.out.write(TRAILER.pack(self.docs, self.nulls, self.ids, self.width, len(edges), len(owners), self.crc, crc, MARK))
        self.out.close()
        return self.name, self.docs, self.ids


class TokenWriter(DataSourceArrowWriter):
    """Rows ``doc_id, text`` in ascending order of partitions and rows, as ids."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.end_id = options["path"].rstrip("/"), int(options.get("end_id", END_ID))
        self.tokenizer = options.get("tokenizer") or default_tokenizer()
        self.definition = Path(self.tokenizer).read_text()
        self.file_ids = int(options.get("file_ids", FILE_IDS))
        where, folder = opened(self.path)
        if not overwrite and where.get_file_info(f"{folder}/{LISTING}").type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} holds token files already")
        where.create_dir(folder, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part = TaskContext.get().partitionId()
        where, folder = opened(self.path)
        tok = tokenizer(self.definition)
        width = 2 if max(tok.vocabulary, self.end_id + 1) <= 1 << 16 else 4
        attempt, done, file = uuid.uuid4().hex[:12], [], None
        for batch in iterator:
            for a, b, buf, off in tb.texts(batch):
                ids, at = tok.encode(buf, off)
                # Every document's ids, with the end id behind.
                sizes = np.diff(at) + 1
                edges = np.concatenate([[0], np.cumsum(sizes)])
                whole = np.full(int(edges[-1]), self.end_id, np.uint32)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes - 1)] = ids
                owners = batch.column("doc_id").slice(a, b - a)
                known = owners.is_valid().to_numpy(zero_copy_only=False)
                numbers = owners.fill_null(0).to_numpy()
                k = 0
                while k < len(sizes):
                    if file is None:
                        file = OneFile(where, folder, f"part-{part:06d}-{attempt}-{len(done):04d}.ids", width)
                    # As many documents as fit, at least one into an empty file.
                    room = edges[k] + self.file_ids - file.ids
                    to = min(int(np.searchsorted(edges, room, side="right")) - 1, k + FILE_DOCS - file.docs, len(sizes))
                    if to <= k and file.docs == 0:
                        to = k + 1
                    if to > k:
                        file.add(numbers[k:to][known[k:to]], int((~known[k:to]).sum()), sizes[k:to], whole[edges[k] : edges[to]])
                        k = to
                    if k < len(sizes):
                        done.append(file.close())
                        file = None
        if file is not None:
            done.append(file.close())
        return Written(part, done)

    def commit(self, messages: list[Written | None]) -> None:
        rows, start = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.part):
            for name, docs, ids in message.files:
                rows.append({"name": name, "docs": docs, "ids": ids, "start": start})
                start += ids
        where, folder = opened(self.path)
        listing = {"tokenizer": self.tokenizer.rsplit("/", 1)[-1], "end_id": self.end_id, "ids": start, "files": rows}
        with where.open_output_stream(f"{folder}/{LISTING}") as out:
            out.write(json.dumps(listing).encode())

    def abort(self, messages: list[Written | None]) -> None:
        where, folder = opened(self.path)
        for message in messages:
            for name, _, _ in message.files if message else []:
                where.delete_file(f"{folder}/{name}")


@dataclass
class FilePart(InputPartition):
    """One file to read and the ids before it."""

    def __init__(self, name: str, start: int):
        super().__init__(name)
        self.name, self.start = name, start


class TokenFile:
    """Random access to one file."""

    def __init__(self, path: str):
        where, name = opened(path)
        self.source = where.open_input_file(name)
        size = self.source.size()
        if size < len(MARK) + TRAILER.size or self.source.read_at(len(MARK), 0) != MARK:
            raise ValueError(f"{path} is no token file")
        fields = TRAILER.unpack(self.source.read_at(TRAILER.size, size - TRAILER.size))
        self.docs, self.nulls, self.ids, self.width, edges, owners, self.ids_crc, crc, mark = fields
        codes = self.source.read_at(edges + owners, len(MARK) + self.ids * self.width)
        if mark != MARK or zlib.crc32(codes) != crc:
            raise ValueError(f"{path} is damaged")
        self.edges, self.owners = EliasFano.from_bytes(codes[:edges]), EliasFano.from_bytes(codes[edges:])

    def starts(self, a: int, b: int) -> np.ndarray:
        """Where documents ``a`` to ``b`` (the end of the one before ``b``) begin in the file."""
        return self.edges.select(np.arange(a, b + 1))

    def doc_ids(self, a: int, b: int) -> pa.Array:
        missing = max(0, min(b, self.nulls) - a)
        have = self.owners.select(np.arange(max(a, self.nulls), max(b, self.nulls)) - self.nulls)
        return pa.array(np.concatenate([np.zeros(missing, np.int64), have]), mask=np.arange(b - a) < missing)

    def read(self, begin: int, end: int) -> np.ndarray:
        data = self.source.read_at((end - begin) * self.width, len(MARK) + begin * self.width)
        return np.frombuffer(data, f"<u{self.width}").astype("<u4")


class TokenReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[FilePart]:
        where, folder = opened(self.path)
        with where.open_input_stream(f"{folder}/{LISTING}") as source:
            listing = json.loads(source.read())
        return [FilePart(f["name"], f["start"]) for f in listing["files"]] or [FilePart("", 0)]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        if not partition.name:  # a list without files
            return
        file, a, crc = TokenFile(f"{self.path}/{partition.name}"), 0, 0
        while a < file.docs:
            starts = file.starts(a, min(a + READ_DOCS, file.docs))
            b = a + max(1, int(np.searchsorted(starts, starts[0] + READ_IDS, side="right")) - 1)
            starts = starts[: b - a + 1]
            ids = file.read(int(starts[0]), int(starts[-1]))
            crc = zlib.crc32(ids.astype(f"<u{file.width}").tobytes(), crc)
            offsets = ((starts - starts[0]) * 4).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
            yield pa.RecordBatch.from_arrays(
                [file.doc_ids(a, b), pa.array(starts[:-1] + partition.start), pa.array(np.diff(starts)), packed],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
            a = b
        if crc != file.ids_crc:
            raise ValueError(f"the ids of {partition.name} are damaged")


class TokenFiles(DataSource):
    """``spark.read.format("token_ids")``: ``doc_id, start, n_tokens, ids`` (32 bits each, little-endian)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options)

    def writer(self, schema, overwrite: bool) -> TokenWriter:
        return TokenWriter(self.options, overwrite)


def write(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """All documents (``doc_id, text``) in ascending ``doc_id`` order as token files in a new folder.

    Rows without or with the same ``doc_id`` are dealt by a hash of the text and the row's number, so that a hot id
    spreads over several tasks.
    """
    docs.sparkSession.dataSource.register(TokenFiles)
    order = ["doc_id", "__hash", "__row"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumns(
        {"__hash": F.xxhash64("text"), "__row": F.monotonically_increasing_id()}
    )
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.write.format(FORMAT).mode("append").options(
        tokenizer=tokenizer_path or default_tokenizer(), end_id=end_id, file_ids=file_ids
    ).save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of all documents in the folder."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format(FORMAT).load(path)


def digests(docs: DataFrame, **options) -> DataFrame:
    """What the files of all documents hold: where each document starts, its ids and their CRC-32."""
    path = scratch_dir(docs.sparkSession, "llm-token-files")
    write(docs, path, **options)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
