"""The kept search index against scores worked out over all texts."""

import math

from pyspark.sql import functions as F

from tiersmith.functions.text import STOP_WORDS, query_terms, stem
from tiersmith.operators import incremental, postings
from tiersmith.operators.postings import PART, SearchIndex
from tiersmith.session import scratch_dir
from tiersmith.streaming import aggregates

CHANGE = "k int, seq int, op string, name string, body string"
BATCHES = [
    [(1, 1, "UPSERT", "hot bolts", "a bolt is hot"), (2, 1, "UPSERT", None, "bolt bolt bolt"), (3, 1, "UPSERT", "hot", ""),
     (4, 1, "UPSERT", None, None), (5, 1, "UPSERT", "cold bolt", "hot water and " + "steam " * 400), (None, 1, "UPSERT", "hot bolt", "")],
    [(1, 2, "UPSERT", "cold", "now cold"), (2, 2, "UPSERT", "hot", "bolt"), (5, 3, "DELETE", "", ""), (6, 1, "UPSERT", "hot bolt", "hot bolt")],
    [(1, 0, "UPSERT", "late hot bolt", ""), (2, 1, "DELETE", "", ""), (3, 5, "UPSERT", "Hot", "BOLTED ärger")],
]
WEIGHTS = {"name": 3, "body": 1}


def words(text):
    return [stem(w) for w in (text or "").lower().split() if w not in STOP_WORDS]


def by_hand(changes, query):
    last = {}
    for c in changes:
        if c[0] is not None and (c[0] not in last or c[1] > last[c[0]][1]):
            last[c[0]] = c
    rows = {k: [w for w in words(c[3]) for _ in range(3)] + words(c[4]) for k, c in last.items() if c[2] != "DELETE"}
    terms, out = query_terms(query), {}
    having = {t: sum(t in ws for ws in rows.values()) for t in terms}
    for k, ws in rows.items():
        if terms and all(t in ws for t in terms):
            rank = sum(ws.count(t) / len(ws) * math.log1p(len(rows) / having[t]) for t in terms)
            out[k] = (sum(ws.count(t) for t in terms), len(ws), round(rank, 6))
    return out


def test_same_ranks_as_scoring_all_texts_after_every_batch(spark):
    index, log = SearchIndex(scratch_dir(spark, "index"), "k", WEIGHTS, parts=4), scratch_dir(spark, "log")
    assert index.search(spark, "hot") is None
    changes = []
    for number, batch in enumerate(BATCHES):
        changes += batch
        df = spark.createDataFrame(batch, CHANGE)
        for _ in range(1 + number % 2):  # a repeated batch counts once
            aggregates.take(df, number, [index], log, ["k"], ["seq"], "op")
        if number == 1:
            index.fold(spark)
        for query in ("the hot bolt", "bolts", "", "nowhere"):
            got = {r.k: (r.hits, r.words, round(r["rank"], 6)) for r in index.search(spark, query).collect()}
            assert got == by_hand(changes, query), (number, query)


def test_only_folders_of_the_terms_are_read(spark):
    index = SearchIndex(scratch_dir(spark, "index"), "k", {"body": 1}, parts=16)
    texts = spark.range(400).selectExpr("cast(id as int) k", "concat('w', id % 50, ' common') body")
    index.apply(None, texts, 0)
    index.apply(texts.limit(0), texts.limit(0), 1)
    found = index.found(spark, "common w7")
    assert found.count() == 400 + 8
    scan = found._jdf.queryExecution().executedPlan().toString()
    filters = scan[scan.index("PartitionFilters:"):].split("]")[0]
    assert PART in filters and "xxhash64" not in filters


def test_postings_of_a_text_are_counted_inside_its_row(spark):
    index = SearchIndex(scratch_dir(spark, "index"), "k", {"name": 3, "body": 1})
    texts = spark.createDataFrame([(1, "hot", "a hot bolt"), (2, None, ""), (3, "b c", None), (4, "x", "y"), (4, "x", "z")], "k int, name string, body string")
    found = index.postings_of(texts, 2)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("b", 3, 3, 6), ("bolt", 1, 1, 5), ("c", 3, 3, 6), ("hot", 1, 4, 5), ("x", 4, 6, 8), ("y", 4, 1, 8), ("z", 4, 1, 8),
    ]
    # No sums, windows and sorts over the postings of many texts: above the words there is only a projection.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan[: plan.index("Generate explode")]


def test_a_task_holds_a_bounded_number_of_postings(spark, monkeypatch):
    monkeypatch.setattr(postings, "PIECE", 1000, raising=False)
    monkeypatch.setattr(incremental, "RANGE_ROWS", 100, raising=False)
    index = SearchIndex(scratch_dir(spark, "index"), "k", {"body": 1}, parts=1)
    texts = spark.range(400).selectExpr("cast(id as int) k", "concat('w', id, ' common') body")
    index.apply(None, texts, 0)

    def largest(path):
        files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count()
        return files.agg(F.max("count")).first()[0], files.count()

    root = f"{index.root}/postings"
    assert largest(f"{root}/log/batch=0")[0] < 400
    index.fold(spark)
    most, files = largest(f"{root}/base/v=1")
    assert most < 300 and files >= 5
    assert index.search(spark, "common").count() == 400


def test_texts_of_a_batch_are_cut_into_words_once(spark, monkeypatch):
    index = SearchIndex(scratch_dir(spark, "index"), "k", {"body": 1}, parts=4)
    texts = spark.range(400).selectExpr("cast(id as int) k", "concat('w', id % 9, ' common') body")
    with monkeypatch.context() as patched:
        # To find ranges, all that is below them is worked out a second time.
        patched.setattr(type(texts), "repartitionByRange", lambda *a: 1 / 0)
        index.apply(None, texts, 0)
    stored = spark.read.parquet(f"{index.root}/postings/log/batch=0")
    assert dict(stored.dtypes)["_sum_words"] == "bigint" and stored.count() == 800
    assert index.search(spark, "common w8").count() == 44
    for tasks in (1, 3, 4, 9):
        most, place = index._place(tasks)
        places = stored.select(place.alias("p"), PART, "term", "k")
        assert places.filter((F.col("p") < 0) | (F.col("p") >= most)).isEmpty() and most >= tasks
        assert places.groupBy("p").agg(F.count_distinct(PART).alias("n")).agg(F.max("n")).first()[0] <= -(-4 // tasks)


def test_changes_of_a_batch_are_worked_out_once(spark, monkeypatch):
    index, log = SearchIndex(scratch_dir(spark, "index"), "k", WEIGHTS, parts=4), scratch_dir(spark, "log")
    aggregates.take(spark.createDataFrame(BATCHES[0], CHANGE), 0, [index], log, ["k"], ["seq"], "op")
    seen = []
    monkeypatch.setattr(SearchIndex, "apply", lambda self, before, after, number: seen.extend([before, after]))
    aggregates.take(spark.createDataFrame(BATCHES[1], CHANGE), 1, [index], log, ["k"], ["seq"], "op")
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in seen]
    assert len(plans) == 2 and not any("Join" in p or "Aggregate" in p for p in plans)
