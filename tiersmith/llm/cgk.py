"""Benchmark decontamination: documents that hold a run of words within a small edit distance of an item.

The CGK random walk reads a word sequence from some start: step ``j`` writes the word it stands on and
a random bit of (step, word) says whether it moves on. Two sequences at a small edit distance fall
into step again after each edit, so their walks agree in many places: edit distance becomes Hamming
distance. Bit sampling picks ``SAMPLES`` steps of the walk as a key; the index holds the keys of all
items for a number of independent walks, and a window start that shares a key with an item is a
candidate. How many walks are needed for the target recall is found on items with random edits at the
largest distance that still counts. Each candidate is verified by the exact edit distance.

Windows are sized by the item: items fall in classes of similar length, and every word position of
every text is a window start of every class. Starts that cannot match are left out before walking:
of the class's words, too few occur in the window, or no run of words as long as the pigeonhole
principle demands. Both tests are necessary conditions, so they lose nothing.

An item of more than ``SEGMENT_WORDS`` words is indexed as segments of equal length. Where the item
occurs with few enough edits, at least one segment does too, with no more than its share of them; so a segment that
is found, verified like any item, says where to look for the whole, and the exact edit distance of the
whole to any run of words there decides. Classes are therefore short, and so is the search for their walks.

The index is built from blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of text, which bounds the
broadcast; each block reads the documents once. Nothing else is shuffled or sent.

Defined cases: words are runs without ASCII white space or punctuation, A-Z in lower case; items and
texts without words (null, empty) match nothing; rows that repeat a document get its result each.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.llm import textbytes as tb

MAX_EDITS = 0.2
TARGET_RECALL = 0.98
SAMPLES = 2
WALKS_AT_ONCE = 128
# No class is known to need a tenth of this; one that does is an error, not a lower recall.
MOST_WALKS = 1 << 14
SEGMENT_WORDS = 256
CLASS_RATIO = 1.25
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 8 << 20
VOCABULARY_BITS, RUN_BITS = 20, 22

U = np.uint64
NORMAL = np.arange(256, dtype=np.uint8)
NORMAL[65:91] += 32
NORMAL[list(string.punctuation.encode())] = 32
PAD = U(0)


def normal_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every normalised word."""
    plain = NORMAL[buf]
    begin, end, text = tb.words(plain, off)
    return tb.span_hashes(plain, begin, end) | U(1), text


def allowed(n: int | np.ndarray, max_edits: float) -> int | np.ndarray:
    return np.floor(np.asarray(n) * max_edits + 1e-9).astype(np.int64)


@dataclass
class LengthClass:
    items: list[int]
    least: int
    most: int
    edits: int
    run: int
    samples: np.ndarray = field(default=None)
    seeds: np.ndarray = field(default=None)
    keys: list[np.ndarray] = field(default_factory=list)
    order: list[np.ndarray] = field(default_factory=list)


@dataclass
class Index:
    """``words`` are items or segments of them; ``item`` and ``offset`` say of which item, and where in it."""

    ids: list[int]
    whole: list[np.ndarray]
    item: np.ndarray
    offset: np.ndarray
    words: list[np.ndarray]
    max_edits: float
    classes: list[LengthClass]
    vocabulary: np.ndarray
    runs: np.ndarray


def walk(words: np.ndarray, start: np.ndarray, stop: np.ndarray, samples: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Key of the CGK walk from each ``start``; ``stop`` is a pad behind the sequence's last word."""
    bits = tb.mix(words ^ seed)
    key = np.zeros(len(start), dtype=U)
    at = start.copy()
    for j in range(int(samples[-1]) + 1):
        if j % 64 == 0 and j:
            bits = tb.mix(bits)
        if j in samples:
            key = tb.mix(key * U(3) + words[at])
        at += ((bits[at] >> U(j % 64)) & U(1)).astype(np.int64)
        np.minimum(at, stop, out=at)
    return key


def laid_out(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences behind each other, a pad after each; where each begins and where its pad is."""
    sizes = np.array([len(s) + 1 for s in sequences])
    start = np.cumsum(sizes) - sizes
    flat = np.full(int(sizes.sum()), PAD, dtype=U)
    for s, at in zip(sequences, start):
        flat[at : at + len(s)] = s
    return flat, start, start + sizes - 1


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = list(words)
    for _ in range(edits):
        kind, at, new = rng.integers(3), int(rng.integers(len(out) + 1)), U(2 * int(rng.integers(1, 1 << 62)) + 1)
        if kind == 0:
            out.insert(at, new)
        elif kind == 1 and at < len(out):
            out[at] = new
        elif len(out) > 1 and at < len(out):
            del out[at]
    return np.array(out, dtype=U)


def plan_walks(items: list[np.ndarray], c: LengthClass, target: float, max_edits: float) -> None:
    """Draws as many walks for a class as find items at the largest distance with the target recall."""
    rng = np.random.default_rng(c.least)
    some = [items[i] for i in c.items[:64]]
    pairs = [(w, edited(w, int(allowed(len(w), max_edits)), rng)) for w in some for _ in range(max(1, 512 // len(some)))]
    missed, sides = pairs, [laid_out(list(s)) for s in zip(*pairs)]
    steps = max(1, int(1.5 * c.least))
    draw = np.random.default_rng(1000 + c.least)
    c.samples, c.seeds = np.empty((0, SAMPLES), np.int64), tb.splitmix(MOST_WALKS, c.least)
    while len(c.samples) < MOST_WALKS:
        # From the start and then ever later: an early step tells more, a late one sees more words.
        drawn = np.sort(draw.integers(0, steps, (WALKS_AT_ONCE, SAMPLES)), axis=1)
        c.samples = np.concatenate([c.samples, drawn])
        for n in range(len(c.samples) - len(drawn), len(c.samples)):
            a, b = (walk(*side, c.samples[n], c.seeds[n]) for side in sides)
            missed = [pair for pair, apart in zip(missed, a != b) if apart]
            if len(missed) / len(pairs) <= 1 - target:
                c.samples, c.seeds = c.samples[: n + 1], c.seeds[: n + 1]
                return
            # Pairs that are found need no further walk.
            sides = [laid_out(list(s)) for s in zip(*missed)]
    raise ValueError(f"items of {c.least} to {c.most} words miss the recall of {target} after {MOST_WALKS} walks")


def build(rows: list[tuple[int, str | None]], max_edits: float = MAX_EDITS, target: float = TARGET_RECALL) -> Index:
    """The index of a bounded block of items."""
    raw = [(t or "").encode() for _, t in rows]
    off = np.cumsum([0, *map(len, raw)]).astype(np.int64)
    hashes, owner = normal_words(np.frombuffer(b"".join(raw), np.uint8), off)
    whole = np.split(hashes, np.searchsorted(owner, np.arange(1, len(rows)))) if rows else []
    words, item, offset = [], [], []
    for i, own in enumerate(whole):
        cuts = np.linspace(0, len(own), max(1, -(-len(own) // SEGMENT_WORDS)) + 1).astype(np.int64)
        for a, b in zip(cuts, cuts[1:]):
            words.append(own[a:b])
            item.append(i)
            offset.append(a)
    size = np.array([len(w) for w in words])
    classes: list[LengthClass] = []
    for i in np.argsort(size, kind="stable"):
        n = int(size[i])
        if not n:
            continue
        if not classes or n >= max(classes[-1].least + 1, classes[-1].least * CLASS_RATIO):
            classes.append(LengthClass([], n, n, 0, 3))
        c, d = classes[-1], int(allowed(n, max_edits))
        c.items.append(int(i))
        c.most, c.edits = n, max(c.edits, d)
        c.run = min(c.run, -(-(n - d) // (d + 1)))
    places = np.array(item, np.int64), np.array(offset, np.int64)
    index = Index([r[0] for r in rows], whole, *places, words, max_edits, classes, np.zeros(1 << VOCABULARY_BITS, U), np.zeros(1 << RUN_BITS, U))
    for k, c in enumerate(classes):
        # Classes beyond 63 share the last flag: the tests stay necessary conditions.
        flag = U(1) << U(min(k, 63))
        every = [words[i] for i in c.items]
        flat = np.concatenate(every)
        index.vocabulary[flat >> U(64 - VOCABULARY_BITS)] |= flag
        _, keys = tb.grams(flat, np.repeat(np.arange(len(every)), [len(w) for w in every]), c.run)
        index.runs[keys >> U(64 - RUN_BITS)] |= flag
        plan_walks(index.words, c, target, max_edits)
        flat, start, stop = laid_out(every)
        for sample, seed in zip(c.samples, c.seeds):
            keys = walk(flat, start, stop, sample, seed)
            order = np.argsort(keys, kind="stable")
            c.keys.append(keys[order])
            c.order.append(np.array(c.items)[order])
    return index


def distances(index: Index, words: np.ndarray, stop: np.ndarray, at: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Least edit distance of each item to a run of words that begins at ``at``."""
    out = np.empty(len(at), np.int64)
    sizes = np.array([len(index.words[i]) for i in item])
    for n in np.unique(sizes):
        d = int(allowed(n, index.max_edits))
        for some in np.array_split(np.flatnonzero(sizes == n), max(1, int((sizes == n).sum() * (n + d) / 2e6) + 1)):
            if not len(some):
                continue
            steps = np.arange(n + d)
            place = at[some, None] + steps
            doc = np.where(place < stop[some, None], words[np.minimum(place, len(words) - 1)], PAD)
            a = np.stack([index.words[i] for i in item[some]])
            offsets = np.arange(n + d + 1)
            row = np.tile(offsets, (len(some), 1))
            for i in range(n):
                new = np.empty_like(row)
                new[:, 0] = i + 1
                new[:, 1:] = np.minimum(row[:, :-1] + (doc != a[:, i, None]), row[:, 1:] + 1)
                row = np.minimum.accumulate(new - offsets, axis=1) + offsets
            out[some] = row.min(axis=1)
    return out


def nearest_run(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edit distance of an item to any run of ``words``, and where the shortest such run begins that ends first."""

    def last_row(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        offsets = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, np.int64) if free else offsets.copy()
        for i, word in enumerate(a):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[:-1] + (b != word), row[1:] + 1)
            row = np.minimum.accumulate(new - offsets) + offsets
        return row

    ends = last_row(item, words, True)
    end = int(ends.argmin())
    # Backwards from that end, the first column with the same distance is the latest start.
    back = last_row(item[::-1], words[:end][::-1], False)
    return int(ends[end]), end - int(np.flatnonzero(back == ends[end])[0])


def wholes(index: Index, flat: np.ndarray, begin: np.ndarray, pad: np.ndarray, hits: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Matches of whole items where segments of them were found (``at, part, which, d``), in the same form but by item."""
    at, part, which, d = hits
    alone = np.array([len(index.whole[i]) for i in index.item[part]]) == np.array([len(index.words[p]) for p in part])
    rows = [(at[alone], index.item[part[alone]], which[alone], d[alone])]
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, p, w in zip(at[~alone].tolist(), part[~alone].tolist(), which[~alone].tolist()):
        i = int(index.item[p])
        n = len(index.whole[i])
        slack = int(allowed(n, index.max_edits))
        start = a - int(index.offset[p])
        spans.setdefault((w, i), []).append((max(int(begin[w]), start - slack), min(int(pad[w]), start + n + slack)))
    for (w, i), own in spans.items():
        merged: list[list[int]] = []
        for low, high in sorted(own):
            if merged and low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], high)
            else:
                merged.append([low, high])
        for low, high in merged:
            distance, first = nearest_run(index.whole[i], flat[low:high])
            if distance <= allowed(len(index.whole[i]), index.max_edits):
                rows.append(tuple(np.array([x], np.int64) for x in (low + first, i, w, distance)))
    return tuple(np.concatenate(x) for x in zip(*rows))


def leaks(index: Index, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, item, distance and first word of the best match of each text and item."""
    none = (np.empty(0, np.int64),) * 4
    hashes, text = normal_words(buf, off)
    if not len(hashes) or not index.classes:
        return none
    n = len(hashes)
    n_texts = len(off) - 1
    first_word = np.searchsorted(text, np.arange(n_texts + 1))
    end = first_word[text + 1]
    position = np.arange(n)
    in_vocabulary = index.vocabulary[hashes >> U(64 - VOCABULARY_BITS)]
    in_run = {}
    for size in {c.run for c in index.classes}:
        at, keys = tb.grams(hashes, text, size)
        in_run[size] = np.zeros(n, U)
        in_run[size][at] = index.runs[keys >> U(64 - RUN_BITS)]
    starts: list[np.ndarray] = []
    for k, c in enumerate(index.classes):
        flag = U(1) << U(min(k, 63))
        seeds = (in_run[c.run] & flag) != 0
        if not seeds.any():
            starts.append(np.empty(0, np.int64))
            continue
        seen = np.zeros(n + 1, np.int32)
        np.cumsum(seeds, out=seen[1:])
        # Only what stands near a run is looked at more closely.
        near = np.flatnonzero(seen[np.minimum(position + c.most + c.edits, end)] > seen[:-1])
        known = np.zeros(n + 1, np.int32)
        np.cumsum((in_vocabulary & flag) != 0, out=known[1:])
        starts.append(near[known[np.minimum(near + c.least, end[near])] - known[near] >= c.least - c.edits])
    hit = np.zeros(n_texts, bool)
    for s in starts:
        hit[text[s]] = True
    if not hit.any():
        return none
    # The texts with starts, each with a pad behind its words.
    chosen = np.flatnonzero(hit)
    flat, begin, pad = laid_out([hashes[first_word[t] : first_word[t + 1]] for t in chosen])
    place = np.zeros(n_texts, np.int64)
    place[chosen] = np.arange(len(chosen))
    found: list[np.ndarray] = []
    for c, s in zip(index.classes, starts):
        if not len(s):
            continue
        which = place[text[s]]
        at = begin[which] + s - first_word[text[s]]
        stop = pad[which]
        for sample, seed, keys, order in zip(c.samples, c.seeds, c.keys, c.order):
            key = walk(flat, at, stop, sample, seed)
            low, high = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
            many = high - low
            some = np.flatnonzero(many)
            if len(some):
                rep = np.repeat(some, many[some])
                nth = np.arange(len(rep)) - np.repeat(np.cumsum(many[some]) - many[some], many[some])
                found.append(np.stack([at[rep], order[low[rep] + nth], which[rep]]))
    if not found:
        return none
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    at, item, which = pairs
    d = distances(index, flat, pad[which], at, item)
    good = d <= allowed(np.array([len(index.words[i]) for i in item]), index.max_edits)
    at, item, which, d = wholes(index, flat, begin, pad, (at[good], item[good], which[good], d[good]))
    order = np.lexsort((at, d, item, which))
    at, item, which, d = at[order], item[order], which[order], d[order]
    best = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (which[1:] != which[:-1])]) if len(at) else np.empty(0, np.int64)
    return chosen[which[best]], item[best], d[best], at[best] - begin[which[best]]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of a bounded size, whatever the benchmark's."""
    block: list[tuple[int, str]] = []
    held = 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or held + len(row.text) > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += len(row.text)
    if block:
        yield block


FOUND = "doc_id long, item_id long, distance long, item_words long, first_word long"


def matches(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, target: float = TARGET_RECALL) -> DataFrame:
    """Per document and item its best match: ``distance`` in words and the ``first_word`` of the run."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = spark.createDataFrame([], FOUND)
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build(block, max_edits, target))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            size = np.array([len(w) for w in index.whole])
            ids = np.array(index.ids)
            for batch in batches:
                for a, b, buf, off in tb.texts(batch):
                    row, item, d, at = leaks(index, buf, off)
                    if len(row):
                        own = batch.column("doc_id").slice(a, b - a).take(pa.array(row))
                        rest = [pa.array(x, pa.int64()) for x in (ids[item], d, size[item], at)]
                        yield pa.RecordBatch.from_arrays([own, *rest], names=["doc_id", "item_id", "distance", "item_words", "first_word"])

        out = out.unionByName(slim.mapInArrow(run, FOUND))
    # Rows may repeat a document, items may share an id: the best match of each pair is kept.
    best = F.min(F.struct("distance", "first_word", "item_words")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.distance", "m.item_words", "m.first_word")


def stage(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, target: float = TARGET_RECALL) -> DataFrame:
    """The documents without any match; a document is judged where it lies, so nothing is shuffled."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(build(block, max_edits, target))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(len(batch), bool)
                for a, _, buf, off in tb.texts(batch):
                    clean[a + leaks(shared.value, buf, off)[0]] = False
                if clean.any():
                    yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return docs
