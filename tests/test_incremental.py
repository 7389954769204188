"""Aggregates with retraction, mergeable sketches, checked arrivals."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tiersmith.operators import sketches
from tiersmith.operators.incremental import Kept
from tiersmith.session import scratch_dir
from tiersmith.sources import quarantine
from tiersmith.sources.landing_table import LandingTable
from tiersmith.streaming import aggregates, arrivals

CHANGE = "k int, seq int, op string, g string, day int, v double"


def by_hand(changes):
    """The aggregate over the last change of each key."""
    last = {}
    for c in changes:
        if c[0] not in last or (c[1], c) > (last[c[0]][1], last[c[0]]):
            last[c[0]] = c
    out = {}
    for _, _, op, g, day, v in last.values():
        if op != "DELETE":
            n, s, have, days = out.get(g, (0, 0.0, False, frozenset()))
            out[g] = (n + 1, s + (v or 0), have or v is not None, days | ({day} - {None}))
    return sorted(((g, n, round(s, 6) if have else None, len(days)) for g, (n, s, have, days) in out.items()), key=repr)


def test_kept_aggregates_equal_the_full_query_after_every_batch(spark):
    rng, root, log = random.Random(1), scratch_dir(spark, "kept"), scratch_dir(spark, "log")
    kept = Kept(root, {"g": F.col("g")}, {"total": F.col("v")}, ("days", F.col("day")))
    assert kept.current(spark) is None
    changes = []
    for number in range(4):
        # Inserts, updates that move rows to other groups, deletes, late and repeated changes, nulls.
        batch = [
            (rng.randrange(30), number * 10 + rng.randrange(-12, 10), rng.choice(["UPSERT", "UPSERT", "DELETE"]), rng.choice(["a", "b", None]),
             rng.choice([1, 2, 3, None]), rng.choice([0.1, 0.2, 1e6 / 3, None, -5.0]))
            for _ in range(40)
        ]
        batch = list({(c[0], c[1]): c for c in batch if (c[0], c[1]) not in {(x[0], x[1]) for x in changes}}.values())
        changes += batch
        df = spark.createDataFrame(batch + batch[:3], CHANGE)
        for _ in range(1 + number % 2):  # a repeated batch counts once
            aggregates.take(df, number, [kept], log, ["k"], ["seq"], "op")
        if number == 2:
            kept.fold(spark)
        got = sorted(((r.g, r.rows, None if r.total is None else round(r.total, 5), r.days) for r in kept.current(spark).collect()), key=repr)
        assert got == [(g, n, None if s is None else pytest.approx(s, abs=1e-4), d) for g, n, s, d in by_hand(changes)]
    kept.fold(spark)
    assert sorted(r.rows for r in kept.current(spark).collect()) == sorted(n for _, n, _, _ in by_hand(changes))


def test_aggregates_follow_a_stream(spark, tmp_path):
    drop, root, log, state = tmp_path / "in", scratch_dir(spark, "kept"), scratch_dir(spark, "log"), scratch_dir(spark, "state")
    drop.mkdir()
    kept = Kept(root, {"g": F.col("g")}, {"total": F.col("v")})
    for n, text in enumerate(["1,1,UPSERT,a,1,5\n2,1,UPSERT,a,1,6\n", "1,2,UPSERT,b,1,7\n2,2,DELETE,,,\n"]):
        (drop / f"f{n}.csv").write_text("k,seq,op,g,day,v\n" + text)
        stream = arrivals.arrivals(spark, str(drop), T.StructType.fromDDL(CHANGE)).drop("_source_file")
        aggregates.maintain(stream, [kept], log, ["k"], ["seq"], "op", state, drain=True).awaitTermination()
    assert rows(kept.current(spark), "g", "rows", "total") == [("b", 1, 7.0)]


def test_sketches_of_batches_add_up(spark):
    root = scratch_dir(spark, "sketch")
    df = spark.range(20000).select((F.col("id") % 7001).alias("a"), F.when(F.col("id") % 4 > 0, F.sqrt("id")).alias("b"), F.concat(F.lit("t"), F.col("id") % 50).alias("c"))
    for n in range(3):
        part = df.filter(F.col("a") % 3 == n)
        sketches.keep(part, root, str(n))
        sketches.keep(part, root, str(n))
    found = {r.column: r for r in sketches.estimates(sketches.merged(spark, root)).collect()}
    exact = df.agg(*(F.countDistinct(c).alias(c) for c in "abc")).first()
    for c in "abc":
        assert abs(found[c].unique_count / exact[c] - 1) <= sketches.DISTINCT_ERROR
        assert (found[c].rows, found[c].nulls) == (20000, 5000 if c == "b" else 0)
    for name, at in sketches.QUARTILES.items():
        for c in "ab":
            share = df.agg(F.avg((F.col(c) <= found[c][name]).cast("double"))).scalar()
            assert abs(df.select(share).first()[0] - at) <= sketches.RANK_ERROR + 1e-3
        assert found["c"][name] is None


def test_arrivals_are_checked_and_known_rows_add_nothing(spark, tmp_path):
    drop, root, state = tmp_path / "in", scratch_dir(spark, "root"), scratch_dir(spark, "state")
    drop.mkdir()
    schema = T.StructType.fromDDL("id int, name string")
    run = lambda where: arrivals.land_checked(spark, str(drop), schema, "things", "drop", root, where, drain=True).awaitTermination()
    (drop / "a.csv").write_text("id,name\n1,x\nbad,y\n2,z,more\n3,w\n")
    run(state)
    (drop / "again.csv").write_text("id,name\n1,x\n3,w\n4,new\n")
    run(state)
    run(scratch_dir(spark, "state"))  # all files again, by a stream that knows none of them
    table = LandingTable(spark, root, "things")
    batches = table.batches()
    table.open(batches)
    assert rows(table.rows([b.batch_id for b in batches if b.landed]), "id", "name") == [(1, "x"), (3, "w"), (4, "new")]
    assert rows(quarantine.items_of(spark, root), "raw_text", "error_class") == [("2,z,more", "arity"), ("bad,y", "arity")]
