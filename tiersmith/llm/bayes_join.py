"""Similarity join of documents on the Jaccard index of their five-word shingles, at least 0.8.

1. Each text becomes 96 MinHash values of 16 bits, and a digest. Equal texts are joined to one class
   representative by the digest alone.
2. 24 bands of four values give candidate buckets: a pair at the threshold shares none of them with
   probability 3e-6. A bucket's members are dealt to blocks of some 256; pairs of blocks are the
   tasks' groups, so no bucket is ever in one group and no pair of documents is a row.
3. In a pair of blocks all MinHash values are compared a third at a time. After each third, pairs
   whose posterior probability of reaching the threshold (uniform prior) is under ``TOLERANCE`` are
   dropped. A pair that shares several bands belongs to the first one, so it is counted once.
4. The survivors of a pair of blocks travel as one bit mask. The texts of the documents in it are
   fetched, their shingle sets built and intersected: the reported links are exact.
5. Links are counted per document, and each group's links are thinned to a spanning forest before
   the connected components are found.

Defined cases: words are separated by ``[\\x20\\x09-\\x0D]``; a text of under five words is one shingle
of all of them; a text without words (null, empty) has no links and is its own class; rows that
repeat both ``doc_id`` and text count once; rows without ``doc_id`` are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm import textbytes as tb
from tiersmith.llm.components import labels
from tiersmith.llm.scratch import stored

THRESHOLD = 0.8
SHINGLE = 5
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-7
BLOCK = 256
MULTIPLIERS = (tb.splitmix(HASHES, 8) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
OFFSETS = (tb.splitmix(HASHES, 9) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(buf: np.ndarray, off: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Text and 64-bit hash of every shingle of a slice (repeats included), by text."""
    begin, end, text = tb.words(buf, off)
    hashes = tb.span_hashes(buf, begin, end)
    at, keys = tb.grams(hashes, text, n)
    owner = text[at]
    counts = np.bincount(text, minlength=len(off) - 1)
    short = (counts > 0) & (counts < n)
    if short.any():
        keep = short[text]
        few, of = hashes[keep], text[keep]
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        rank = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)]))
        whole = np.add.reduceat(few * tb.powers(tb.BASE, n)[rank], starts)
        owner = np.concatenate([owner, of[starts]])
        keys = np.concatenate([keys, tb.mix(whole + np.uint64(n + 1))])
        order = np.argsort(owner, kind="stable")
        owner, keys = owner[order], keys[order]
    return owner, keys


def minhashes(owner: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of 16-bit MinHash values; rows without shingles stay zero."""
    out = np.zeros((n, HASHES), dtype=np.uint16)
    if len(keys):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        small = (keys >> np.uint64(32)).astype(np.uint32)
        for i in range(HASHES):
            h = (small ^ OFFSETS[i]) * MULTIPLIERS[i]
            # The high bits decide, the low ones of the winner tell sets apart also where it is small.
            out[owner[starts], i] = fold(np.minimum.reduceat(h, starts))
    return out


def fold(low: np.ndarray) -> np.ndarray:
    return ((low * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(np.uint16)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (128 bits of the text's SHA-256), ``filled`` and ``sig`` of each row with an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in tb.texts(batch, limit=tb.SLICE_BYTES // 2):
                owner, keys = shingle_sets(buf, off)
                sig = minhashes(owner, keys, b - a)
                filled = np.bincount(owner, minlength=b - a) > 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a), batch.column("key").slice(a, b - a), pa.array(filled),
                        pa.array([row.tobytes() for row in sig], pa.binary()),
                    ],
                    names=["doc_id", "key", "filled", "sig"],
                )

    keyed = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    return keyed.mapInArrow(run, "doc_id long, key binary, filled boolean, sig binary")


def text_key() -> F.Column:
    return F.expr("substring(unhex(sha2(coalesce(text, ''), 256)), 1, 16)")


@lru_cache(maxsize=None)
def least_matches(compared: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values of ``compared`` at which a pair may still reach the threshold."""
    grid = (np.arange(4000) + 0.5) / 4000
    for m in range(compared + 1):
        # Uniform prior, so the posterior is Beta(m + 1, compared - m + 1).
        logs = m * np.log(grid) + (compared - m) * np.log1p(-grid)
        logs += lgamma(compared + 2) - lgamma(m + 1) - lgamma(compared - m + 1)
        if np.exp(logs[grid >= threshold]).sum() / len(grid) >= tolerance:
            return m
    return compared


def survivors(
    sig: np.ndarray, p: np.ndarray, q: np.ndarray, band: np.ndarray, threshold: float, tolerance: float
) -> np.ndarray:
    """Which pairs of rows of ``sig`` belong to their ``band`` and may still reach the threshold."""
    keys = sig.view(np.uint64)
    alive = np.flatnonzero((keys[p] == keys[q]).argmax(axis=1) == band)
    hits = np.zeros(len(alive), np.int16)
    for first in range(0, HASHES, STEP):
        part = slice(first, first + STEP)
        hits += (sig[p[alive], part] == sig[q[alive], part]).sum(axis=1, dtype=np.int16)
        stay = hits >= least_matches(first + STEP, threshold, tolerance)
        alive, hits = alive[stay], hits[stay]
    return alive


def fixed(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    data = column.cast(pa.binary(width))
    raw = np.frombuffer(data.buffers()[1], np.uint8)[data.offset * width : (data.offset + len(data)) * width]
    return raw.view(kind).reshape(len(data), -1)


def spacious(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with texts that may exceed 2 GiB in one column."""
    columns = [c.cast(pa.large_string()) if c.type == pa.string() else c for c in batch.columns]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    names = parts[0].schema.names
    return pa.RecordBatch.from_arrays([pa.concat_arrays([p.column(n) for p in parts]) for n in names], names=names)


def whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Sorted batches cut so that no group goes on in the next one, with where each group begins.

    The rows of a group that is still open wait as they came and are copied once, when it ends.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        batch = spacious(batch)
        new = np.zeros(len(batch), bool)
        for name in by:
            column = batch.column(name)
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
            if held:
                new[0] |= held[-1].column(name)[-1] != column[0]
        cuts = np.flatnonzero(new)
        if not len(cuts):
            held.append(batch)
            continue
        last = int(cuts[-1])
        waiting = sum(map(len, held))
        done = [*held, batch.slice(0, last)] if last else held
        yield joined(done), np.concatenate([[0], waiting + cuts[:-1]]).astype(np.int64)
        held = [batch.slice(last)]
    if held:
        yield joined(held), np.array([0])


PAIRS_AT_ONCE = 1 << 18


def candidate_blocks(unique: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """One row per pair of blocks with survivors: its members and a bit mask of their pairs."""
    band_keys = F.expr(f"transform(sequence(0, {BANDS - 1}), b -> substring(sig, b * {2 * ROWS} + 1, {2 * ROWS}))")
    banded = unique.where("filled").select("node", F.posexplode(band_keys).alias("band", "value"))
    buckets = banded.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    inside = banded.join(buckets, ["band", "value"]).withColumn("blocks", F.expr(f"cast(ceil(n / {BLOCK}) AS int)"))
    inside = inside.withColumn("own", F.expr("cast(pmod(xxhash64(node, band), blocks) AS int)"))
    dealt = inside.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "node", "band", "value", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    dealt = dealt.join(unique.select("node", "sig"), "node")
    by = ["band", "value", "i", "j"]

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, by):
            sig = fixed(rows.column("sig"), 2 * HASHES, np.uint16)
            node, band, i, j, own = (rows.column(c).to_numpy() for c in ("node", "band", "i", "j", "own"))
            ends = np.append(starts[1:], len(rows))
            group = np.repeat(np.arange(len(starts)), ends - starts)
            # The partners of a row: all behind it in its block, or the whole other block.
            left = own == i
            n_left = np.add.reduceat(left, starts, dtype=np.int64)
            first = np.where(i == j, np.arange(len(rows)) + 1, starts[group] + n_left[group])
            count = np.where((i == j) | left, ends[group] - first, 0)
            until = np.cumsum(count)
            at, found = 0, []
            while at < len(rows):
                to = max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
                n = count[at:to]
                p = np.repeat(np.arange(at, to), n)
                q = np.arange(len(p)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at:to], n)
                alive = survivors(sig, p, q, band[p], threshold, tolerance)
                found.append(np.stack([p[alive], q[alive]]))
                at = to
            p, q = np.concatenate(found, axis=1)
            members, masks = [], []
            cuts = np.flatnonzero(np.r_[True, group[p[1:]] != group[p[:-1]], True]) if len(p) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                some, index = np.unique(np.concatenate([p[a:b], q[a:b]]), return_inverse=True)
                mask = np.zeros((len(some), len(some)), bool)
                mask[index[: b - a], index[b - a :]] = True
                members.append(node[some])
                masks.append(np.packbits(mask).tobytes())
            if members:
                yield pa.RecordBatch.from_pydict({"members": members, "mask": masks}, schema=found_schema)

    found_schema = pa.schema([("members", pa.list_(pa.int64())), ("mask", pa.binary())])
    ordered = dealt.repartition(*by).sortWithinPartitions(*by, "own", "node")
    return ordered.mapInArrow(prune, "members array<long>, mask binary").select(
        F.monotonically_increasing_id().alias("block"), "members", "mask"
    )


def intersections(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sorted sets, by the cheaper of two exact ways."""
    rows, at_row = np.unique(pairs[:, 0], return_inverse=True)
    cols, at_col = np.unique(pairs[:, 1], return_inverse=True)
    size = np.array([len(x) for x in sets])
    total = int(size[rows].sum() + size[cols].sum())
    merge = 12e-9 * int(size[pairs].sum()) + 8e-6 * len(pairs)
    if merge < 80e-9 * total + 1e-10 * len(rows) * len(cols) * total:
        out = np.empty(len(pairs), np.int64)
        for k, (i, j) in enumerate(pairs):
            both = np.concatenate([sets[i], sets[j]])
            both.sort()
            out[k] = np.count_nonzero(both[1:] == both[:-1])
        return out
    every = np.unique(np.concatenate([sets[i] for i in np.union1d(rows, cols)]))
    grid = np.zeros((len(rows), len(cols)))
    for at in range(0, len(every), 4096):
        part = every[at : at + 4096]
        sides = []
        for side in (rows, cols):
            has = np.zeros((len(side), len(part)), np.float32)
            for row, i in enumerate(side):
                a, b = np.searchsorted(sets[i], part[0]), np.searchsorted(sets[i], part[-1], side="right")
                has[row, np.searchsorted(part, sets[i][a:b])] = 1
            sides.append(has)
        grid += sides[0] @ sides[1].T
    return grid[at_row, at_col].astype(np.int64)


def forest(pairs: np.ndarray, n: int) -> list[int]:
    """The least member of each member's tree of links."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in pairs.tolist():
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def verified(blocks: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Exact links: per block one row per linked member with ``links`` and an edge to ``root``.

    ``texts`` has ``node, text, copies``; ``links`` counts the copies of what the member is linked to.
    """
    members = blocks.select("block", F.posexplode("members").alias("at", "node"), F.when(F.col("at") == 0, F.col("mask")).alias("mask"))
    # Each text is fetched once however many blocks want it, then dealt to them.
    loaded = texts.join(members, "node").repartition("block").sortWithinPartitions("block", "at")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, ["block"]):
            nodes, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
            out: list[tuple[int, int, int]] = []
            for a, b in zip(starts, np.append(starts[1:], len(rows))):
                n = int(b - a)
                sets = [np.empty(0, np.uint64)] * n
                for first, last, buf, off in tb.texts(rows.slice(a, n)):
                    owner, keys = shingle_sets(buf, off)
                    cuts = np.searchsorted(owner, np.arange(last - first + 1))
                    for k in range(last - first):
                        sets[first + k] = np.unique(keys[cuts[k] : cuts[k + 1]])
                mask = np.unpackbits(np.frombuffer(rows.column("mask")[int(a)].as_py(), np.uint8), count=n * n)
                pairs = np.argwhere(mask.reshape(n, n))
                both = intersections(sets, pairs)
                size = np.array([len(x) for x in sets])
                pairs = pairs[both >= threshold * (size[pairs].sum(axis=1) - both) - 1e-9]
                links = np.zeros(n, np.int64)
                np.add.at(links, pairs[:, 0], copies[a + pairs[:, 1]])
                np.add.at(links, pairs[:, 1], copies[a + pairs[:, 0]])
                roots = forest(pairs, n)
                out += [(int(nodes[a + k]), int(links[k]), int(nodes[a + roots[k]])) for k in range(n) if links[k]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["node", "links", "root"])

    return loaded.select("block", "at", "node", "copies", "text", "mask").mapInArrow(check, "node long, links long, root long")


def classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, key, class_id, n_links`` for each distinct ``(doc_id, text)`` with an id.

    ``class_id`` is the least ``doc_id`` of the connected class, ``n_links`` the number of other
    documents at the threshold or above, equal texts included.
    """
    signed = stored(signatures(docs), "signatures")
    ids = signed.select("doc_id", "key").distinct()
    unique = signed.groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("filled").alias("filled"),
        # Rows may repeat a document; only distinct documents are copies.
        F.count_distinct("doc_id").alias("copies"),
    )
    unique = stored(unique.withColumn("node", F.monotonically_increasing_id()), "unique-texts")
    blocks = stored(candidate_blocks(unique, threshold, tolerance), "candidates")
    wanted = blocks.select(F.explode("members").alias("node")).distinct()
    reps = unique.join(wanted, "node").select("node", "key", "rep", "copies")
    rows = docs.select(F.col("doc_id").cast("long").alias("rep"), "text").where("rep IS NOT NULL")
    texts = reps.join(rows, "rep").where(text_key() == F.col("key")).select("node", "text", "copies").dropDuplicates(["node"])
    found = stored(verified(blocks, texts, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = labels(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("linked"), "root")
    named = unique.join(links, "node", "left").join(roots, F.col("node") == F.col("linked"), "left")
    named = stored(
        named.select("key", "rep", "copies", "filled", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")),
        "linked-texts",
    )
    heads = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    per_text = named.join(heads, "root").select("key", "class_id", "filled", (F.col("links") + F.col("copies") - 1).alias("links"))
    return ids.join(per_text, "key").select(
        "doc_id",
        "key",
        F.when(F.col("filled"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("filled"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def stage(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class stays, the one with the least ``doc_id``; rows without id stay."""
    found = classes(docs, threshold)
    heads = found.where("doc_id = class_id").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key"))
    marked = docs.join(heads, docs["doc_id"].cast("long") == F.col("__id"), "left")
    kept = marked.where((F.col("__id").isNotNull() & (text_key() == F.col("__key")))).dropDuplicates(["__id", "__key"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
