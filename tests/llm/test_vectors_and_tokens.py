"""Tokenizing, clustering, fill-in-the-middle and token files against brute force and exact round trips."""

import glob
import hashlib
import json
import math
import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tiersmith.llm import fim_chunks, rotated_clusters, token_files, tokens
from tiersmith.llm import textbytes as tb
from tiersmith.llm.elias_fano import BLOCK, EliasFano

DEFINITION = open(token_files.default_tokenizer()).read()
DIRECT = Tokenizer.from_str(DEFINITION)
AWKWARD = [None, "", " \n\t ", "one", "É ü x\r\ny\x0b", "á Á é.", "<|endoftext|> Aa.", "ﬁ ǅ İ ß", "same words here " * 30, "x " * 20000, "日本 語。 x!!! 1234 a1.", " a b\u0000c"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


# ---------------------------------------------------------------- tokenizing


def random_texts(seed, n):
    rng = random.Random(seed)
    marks = ["a", "B", "z", "é", "É", "́", "1", "9", ".", ",", "!?", "'s", "'", "#", "<|", "|>", "<|endoftext|>", " ", "  ", "\n", "\t", " ", "İ", "ß", "ﬁ", "日", "‍", "_", "-", "\x00", "😀"]
    return ["".join(rng.choice(marks) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def same_ids(tok, texts):
    want = [e.ids for e in DIRECT.encode_batch(texts, add_special_tokens=False)]
    ids, at = tok.encode(*slice_of(texts))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_ids_are_those_of_the_library():
    tok = tokens.WordTokenizer(DEFINITION)
    same_ids(tok, [t or "" for t in AWKWARD])
    for seed in range(4):  # the later ones meet a filled cache
        same_ids(tok, random_texts(seed, 5000))
    same_ids(tok, [])
    same_ids(tok, ["", ""])


def test_pieces_with_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    hashes = tb.span_hashes
    monkeypatch.setattr(tb, "span_hashes", lambda *a: hashes(*a) & np.uint64(0xFFFF0007))
    tok = tokens.WordTokenizer(DEFINITION)
    monkeypatch.setattr(tokens, "SLOTS", 1 << 12)
    tok.clear()
    for seed in range(2):
        same_ids(tok, random_texts(seed, 200))
        monkeypatch.setattr(tb, "span_hashes", lambda *a: hashes(*a) & np.uint64(7))
        tok.clear()


def test_full_cache_starts_again(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_PIECES", 50)
    tok = tokens.WordTokenizer(DEFINITION)
    for seed in range(3):
        same_ids(tok, random_texts(seed, 100))


# ---------------------------------------------------------------- clustering


def clusters_by_hand(rows, k=16, rounds=3, dims=64, scale=64, seed=1):
    """Exact k-means over (vec_id, vector) pairs in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    h = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [list(q) for _, q in sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else h(r[0]), np.array(r[1], "<i4").tobytes()))[:k]]

    def near(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [near(q)[1] for _, q in kept]
        for i in range(len(centroids)):
            members = [q for (_, q), o in zip(kept, own) if o == i]
            if members:
                centroids[i] = [sum(x) // len(members) for x in zip(*members)]
    last = [(i, *near(q)) for i, q in kept]
    per = {c: sum(d for _, d, o in last if o == c) for c in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, per[c], sum(per.values()), sha[c]) for i, d, c in last), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def test_clusters_match_brute_force_on_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(i % 5, 0.3, 64)]) for i in range(150)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]  # repeats, ties, no id
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63)]
    rows += [(205, [math.nan] + [1.0] * 63), (206, [math.inf] + [1.0] * 63), (207, [-math.inf] * 64), (208, [0.0] * 64), (209, [-0.01] * 64)]
    df = vectors(spark, rows).withColumn("cluster", F.lit("mine")).withColumn("q", F.lit(1)).withColumn("rest", F.lit(2))
    assert result(rotated_clusters.clusters(df.repartition(5))) == clusters_by_hand(rows)


@pytest.mark.parametrize("leading", [1, 3])
def test_ties_and_empty_clusters(spark, leading):
    rng = random.Random(3)
    # Few distinct vectors in few dimensions: many equal distances, seeds that coincide, clusters left empty.
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(60)]
    got = rotated_clusters.clusters(vectors(spark, rows, "double"), k=12, dims=3, scale=2, leading=leading)
    assert result(got) == clusters_by_hand(rows, 12, 3, 3, 2)


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    assert result(rotated_clusters.clusters(vectors(spark, rows))) == clusters_by_hand(rows)
    none = rotated_clusters.clusters(vectors(spark, [(1, None)]))
    assert none.count() == 0 and none.dtypes == rotated_clusters.clusters(vectors(spark, rows)).dtypes


def test_far_components_are_refused_by_name(spark):
    with pytest.raises(Exception, match="vector 5 is beyond"):
        rotated_clusters.clusters(vectors(spark, [(5, [1e30] + [0.0] * 63)]))


def test_bounds_leave_few_pairs_where_vectors_have_structure():
    rng = np.random.default_rng(2)
    c = np.floor(64 * rng.normal(0, 1, (16, 64))).astype(np.int64)
    q = c[rng.integers(0, 16, 4000)] + rng.integers(-9, 10, (4000, 64))
    mean = q.mean(axis=0)
    _, axes = np.linalg.eigh(np.cov(q.T))
    turn = rotated_clusters.Rotation(mean, axes[:, ::-1][:, :16])
    lead, rest = turn.split(q)
    cluster, distance, pairs = rotated_clusters.nearest(q, lead.astype("f4"), rest.astype("f4"), rotated_clusters.Model(turn, c))
    every = ((q[:, None, :] - c) ** 2).sum(axis=2)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert pairs < 1.2 * len(q)


# ---------------------------------------------------------------- fill in the middle


def rearranged_by_hand(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_rearranged_texts_match_brute_force_and_are_restored(spark):
    rng = random.Random(5)
    shared = ["".join(rng.choice("abc déf日😀 .\n") for _ in range(900)) for _ in range(6)]
    texts = AWKWARD + ["".join(rng.choice(shared)[: rng.randint(1, 900)] for _ in range(rng.randint(1, 9))) for _ in range(120)]
    # Markers anywhere, also across chunk boundaries, and what only looks like one.
    texts += [shared[0][:k] + m + shared[1] for k in range(0, 900, 61) for m in ("<P>", "<S>", "<M>", "<P", "<<", "<S >")]
    texts += ["<" * 300, "<P" * 2000, "é" * 30000 + "<M>" + "é" * 30000, "́" * 5000]
    ids = [*range(len(texts) - 2), None, 3]
    docs = documents(spark, texts, ids).withColumn("form", F.lit("mine")).withColumn("n", F.lit(1))
    rows = fim_chunks.rearranged(docs.repartition(3))
    want = sorted((rearranged_by_hand(i, t) for i, t in zip(ids, texts)), key=repr)
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == want
    back = rows.select("doc_id", fim_chunks.original(F.col("output"), F.col("form")).alias("text"))
    assert sorted((tuple(r) for r in back.collect()), key=repr) == sorted(((i, t or "") for i, t in zip(ids, texts)), key=repr)
    assert fim_chunks.digests(docs.limit(0)).count() == 0


def test_chunks_cover_texts_and_are_found_again():
    rng = random.Random(6)
    passage = "".join(rng.choice("abcdefgh éß😀") for _ in range(6000))
    texts = ["".join(rng.choice("xyz ü") for _ in range(rng.randint(0, 3000))) + passage for _ in range(20)]
    buf, off = slice_of(texts)
    raw, ends = buf.tobytes(), fim_chunks.candidates(buf)
    memo = fim_chunks.Memo(("<P>", "<S>", "<M>"))
    for text, a, b in zip(texts, off.tolist(), off[1:].tolist()):
        stops = list(fim_chunks.chunk_ends(raw, ends, a, b))
        parts = [raw[x:y] for x, y in zip([a, *stops[:-1]], stops)]
        assert b"".join(parts).decode() == text
        assert all(fim_chunks.LEAST <= len(p) <= fim_chunks.MOST + 3 for p in parts[:-1])
        until, marked = memo.joined([memo.summary(p) for p in parts])
        assert until[-1] == len(text) and not marked
    assert memo.hits > 0.6 * memo.asked


def test_cache_is_emptied_and_long_markers_are_refused():
    memo = fim_chunks.Memo(("<P>",), limit=1000)
    for i in range(50):
        assert memo.summary(b"%d" % i * 40).points == len(str(i)) * 40
    assert len(memo.known) < 10
    with pytest.raises(ValueError):
        fim_chunks.Memo(("m" * 18,))


# ---------------------------------------------------------------- Elias-Fano


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=300), st.integers(0, 62))
def test_numbers_come_back(values, shift):
    values = np.array(sorted(v >> shift for v in values), np.int64)
    code = EliasFano.from_bytes(EliasFano.of(values).to_bytes())
    assert code.all().tolist() == values.tolist()
    assert code.select(np.arange(len(values))).tolist() == values.tolist()


def test_boundaries_take_two_bits_more_than_their_low_bits():
    sizes = np.random.default_rng(4).integers(1, 2000, 200_000)
    edges = np.cumsum(sizes)
    code = EliasFano.of(edges)
    bound = 2 + math.ceil(math.log2(edges[-1] / len(edges)))
    assert 8 * len(code.to_bytes()) <= bound * len(edges) + BLOCK + 8 * 32
    assert 8 * code.before.nbytes < 0.25 * len(edges) and code.before.dtype == np.uint32
    at = np.random.default_rng(5).integers(0, len(edges), 5000)
    assert (code.select(at) == edges[at]).all()


def test_wrong_sequences_are_refused():
    with pytest.raises(ValueError):
        EliasFano.of(np.array([3, 2]))
    with pytest.raises(ValueError):
        EliasFano.from_bytes(EliasFano.of(np.arange(9)).to_bytes()[:-1])
    with pytest.raises(IndexError):
        EliasFano.of(np.arange(9)).select(np.array([9]))


# ---------------------------------------------------------------- token files


def encoded(text):
    ids = DIRECT.encode(text or "", add_special_tokens=False).ids + [1]
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("file_ids", [1 << 25, 100])
def test_token_files_round_trip(spark, tmp_path, file_ids):
    texts = AWKWARD + random_texts(9, 60) + ["twice", "twice", "other", None]
    ids = [*range(5, 5 + len(AWKWARD) + 60), 3, 3, 3, None]
    docs = documents(spark, texts, ids).withColumn("start", F.lit("mine")).withColumn("ids", F.lit(1))
    path = f"file://{tmp_path}/ids"
    token_files.write(docs.repartition(4), path, file_ids=file_ids)
    rows = token_files.read(spark, path).orderBy(F.asc_nulls_first("doc_id"), "start").collect()
    assert sorted(((r.doc_id, bytes(r.ids)) for r in rows), key=repr) == sorted(((i, encoded(t)) for i, t in zip(ids, texts)), key=repr)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    listing = json.load(open(f"{tmp_path}/ids/_files.json"))
    assert listing["ids"] == at and (file_ids > 100 or len(listing["files"]) > 5)
    with pytest.raises(Exception, match="already"):
        token_files.write(docs, path)


def test_hot_id_is_dealt_to_several_tasks(spark, tmp_path):
    docs = spark.range(4000).select(F.lit(7).alias("doc_id"), F.lit("the same text").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(docs, str(tmp_path / "ids"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    listing = json.load(open(tmp_path / "ids" / "_files.json"))
    assert len(listing["files"]) > 1 and max(f["docs"] for f in listing["files"]) < 2500
    rows = token_files.read(spark, str(tmp_path / "ids"))
    assert rows.agg(F.countDistinct("start"), F.countDistinct("ids"), F.count("*")).first()[:] == (4000, 1, 4000)


def test_files_of_lost_tasks_are_not_read_and_damage_is_noticed(spark, tmp_path):
    docs, path = documents(spark, ["some words here"] * 5), str(tmp_path / "ids")
    token_files.write(docs.coalesce(1), path)
    (file,) = glob.glob(f"{path}/*.ids")
    with open(f"{path}/part-000000-lost-0000.ids", "wb") as out:
        out.write(open(file, "rb").read()[:20])
    assert token_files.read(spark, path).count() == 5
    data = bytearray(open(file, "rb").read())
    data[len(token_files.MARK)] ^= 1
    open(file, "wb").write(data)
    with pytest.raises(Exception, match="damaged"):
        token_files.read(spark, path).collect()


def test_documents_are_found_one_by_one(spark, tmp_path):
    texts = random_texts(11, 300)
    token_files.write(documents(spark, texts).coalesce(1), str(tmp_path / "ids"))
    (name,) = [f for f in os.listdir(tmp_path / "ids") if f.endswith(".ids")]
    file = token_files.TokenFile(str(tmp_path / "ids" / name))
    for k in (0, 17, 299):
        begin, end = file.starts(k, k + 1).tolist()
        assert file.doc_ids(k, k + 1).to_pylist() == [k] and file.read(begin, end).tobytes() == encoded(texts[k])


def test_no_documents(spark):
    none = token_files.digests(documents(spark, []))
    assert none.count() == 0
    assert none.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]


def test_registered_token_query_matches_direct_encoding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    at = 0
    got = {r.doc_id: r for r in token_files.digests(docs).collect()}
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = encoded(r.text)
        assert tuple(got[r.doc_id]) == (r.doc_id, at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
