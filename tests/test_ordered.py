"""The split windows against plain Python, with one key that holds most of the rows."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiersmith.operators import ordered, records
from tiersmith.operators.quantiles import distribution, value_counts

START = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(3)
    data = []
    for i in range(900):
        key = "hot" if i % 3 else rnd.choice([None, "k1", "k2", "k3", "k4", "k5", "k6"])
        ts = START + datetime.timedelta(minutes=rnd.randint(0, 3000)) if rnd.random() > 0.01 else None
        value = None if rnd.random() < 0.1 else round(rnd.random() * 100, 2)
        data.append((i, key, ts, value))
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, v double")
    return data, ordered.with_range_bucket(df, ["k"], ["ts", "id"], "bucket", ranges=12)


def by_key(data):
    out = {}
    for row in sorted(data, key=lambda r: (r[2] or datetime.datetime.min, r[0])):
        out.setdefault(row[1], []).append(row)
    return out


def test_a_hot_key_covers_several_ranges(skewed):
    _, df = skewed
    split = {r["k"]: r["count"] for r in df.select("k", "bucket").distinct().groupBy("k").count().collect()}
    assert split.pop("hot") > 5 and max(split.values()) <= 2
    assert df.groupBy("bucket").count().agg({"count": "max"}).first()[0] < 200


def test_previous_value(skewed):
    data, df = skewed
    got = {r.id: r.p for r in ordered.previous_value(df, ["k"], "bucket", ["ts", "id"], "v", "p").collect()}
    want = {}
    for rows in by_key(data).values():
        for before, row in zip([None, *rows], rows, strict=False):
            want[row[0]] = before[3] if before else None
    assert got == want


@pytest.mark.parametrize("window", [2, 7])
def test_moving_mean(skewed, window):
    data, df = skewed
    got = {r.id: r.m for r in ordered.moving_mean(df, ["k"], "bucket", ["ts", "id"], "v", "m", window).collect()}
    assert len(got) == len(data)
    for rows in by_key(data).values():
        for i, row in enumerate(rows):
            known = [r[3] for r in rows[max(0, i - window + 1) : i + 1] if r[3] is not None]
            want = sum(known) / len(known) if known else None
            assert got[row[0]] == (pytest.approx(want) if known else None)


@pytest.mark.parametrize("with_floor", [False, True])
def test_best_before(spark, skewed, with_floor):
    data, df = skewed
    floor = spark.createDataFrame([("hot", 60.0), ("k1", 1.0)], "k string, v double") if with_floor else None
    out = ordered.with_best_before(df.filter("k IS NOT NULL"), ["k"], "bucket", ["ts", "id"], "v", "best", floor)
    got = {r.id: r.best for r in out.collect()}
    data = [r for r in data if r[1] is not None]
    assert len(got) == len(data)
    for key, rows in by_key(data).items():
        best = {"hot": 60.0, "k1": 1.0}.get(key) if with_floor else None
        for row in rows:
            assert got[row[0]] == best
            if row[3] is not None:
                best = row[3] if best is None else max(best, row[3])


def test_records_follow_the_sequential_rule(spark):
    rnd = random.Random(5)
    workouts = [(w, w % 3, datetime.date(2024, 1, 1) + datetime.timedelta(days=w // 4)) for w in range(60)]
    sets, seen = [], []
    for w, athlete, day in workouts:
        for n in range(1, 6):
            s = (w, rnd.randint(0, 2), n, rnd.choice(["warmup", "working", "working"]), float(rnd.randint(20, 120)), rnd.randint(0, 12))
            sets.append(s)
            seen.append((day, w, n, s[4], s[5], athlete, s[1], s[3]))
    best, want = {}, []
    for day, w, n, weight, reps, athlete, exercise, kind in sorted(seen, key=lambda r: r[:5]):
        if kind != "working" or reps <= 0:
            continue
        e = float(np.floor(weight * (30 + reps) / 30 * 10 + 0.5 + 1e-9) / 10)
        old = best.get((athlete, exercise))
        if old is None or e > old:
            want.append((athlete, exercise, w, n, e, old))
            best[(athlete, exercise)] = e
    candidates = records.candidate_sets(
        spark.createDataFrame(sets, "workout_id int, exercise_id int, set_number int, set_type string, weight_kg double, reps int"),
        spark.createDataFrame(workouts, "id int, athlete_id int, workout_date date"),
    )
    found = records.new_records(candidates, ["workout_date", "workout_id", "set_number", "weight_kg", "reps"])
    got = [(r.athlete_id, r.exercise_id, r.workout_id, r.set_number, r.new_value, r.previous_value) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    first = [r for r in found.collect() if r.previous_value is None]
    assert first and all(r.improvement_pct == 100.0 for r in first)


@pytest.mark.parametrize("size", [1, 2, 3, 50, 3000])
def test_distribution_against_numpy(spark, size):
    rng = np.random.default_rng(size)
    # A third of the values are one value; the rest are spread over several magnitudes.
    wide = np.round(np.exp(rng.normal(0, 3, size)), 3)
    hot = np.where(rng.random(size) < 0.34, 7.0, wide)
    groups = {"wide": wide, "hot": hot, "constant": np.zeros(size)}
    data = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("wide", None)]
    counts = value_counts(spark.createDataFrame(data, "g string, value double"), ["g"])
    probs = {"q1": 0.25, "q2": 0.5, "q3": 0.75, "q99": 0.99, "low": 0.0, "high": 1.0}
    got = {r.g: r for r in distribution(counts, ["g"], probs).collect()}
    for g, xs in groups.items():
        assert got[g].total_count == size
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(float(np.quantile(xs, p)))
        assert got[g]["mean"] == pytest.approx(float(xs.mean()))
        if size > 1:
            assert got[g]["std"] == pytest.approx(float(xs.std(ddof=1)))
    assert got["constant"].zeros == size


def test_cut_points_are_even_and_in_order(spark):
    names = ["", "a'b", "ä", None, "z"]
    data = [(names[i % 5], None if i % 11 == 0 else START + datetime.timedelta(seconds=i % 97), i / 7) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, ts timestamp, v double")
    by = ["k", "ts", "v"]
    got = ordered.with_range_bucket(df, ["k"], ["ts", "v"], "bucket", ranges=16).orderBy(*by).collect()
    buckets = [r.bucket for r in got]
    assert buckets == sorted(buckets) and set(buckets) == set(range(16))
    assert max(buckets.count(b) for b in range(16)) < 3 * 2000 / 16
    assert ordered.with_range_bucket(df.limit(0), ["k"], ["ts"], "b").count() == 0
    assert {r.b for r in ordered.with_range_bucket(df.limit(1), ["k"], ["ts"], "b", ranges=4).collect()} <= {0, 1}


def test_no_rows_are_written_to_cut_ranges(spark, skewed, monkeypatch):
    monkeypatch.setattr("tiersmith.session.scratch_dir", None)
    df = skewed[1].select("id", "k", "ts", "v")
    timed = ordered.with_range_bucket(df, ["k"], ["ts", "id"], "b", ranges=64)
    plan = ordered.previous_value(timed, ["k"], "b", ["ts", "id"], "v", "p")._jdf.queryExecution().optimizedPlan().toString()
    # No exchange by range, and the cut points are one constant a step.
    assert "RepartitionByExpression" in plan and "sort order" not in plan and "named_struct" not in plan
    assert len(plan) < 200_000


def test_one_day_of_one_exercise_is_cut(spark):
    rnd, day = random.Random(9), datetime.date(2024, 5, 1)
    sets = [(1, 1, day, w, n, rnd.choice([None, float(rnd.randint(1, 10_000))])) for w in range(300) for n in range(4)]
    df = spark.createDataFrame(sets, "athlete_id int, exercise_id int, workout_date date, workout_id int, set_number int, estimated_1rm double")
    order = ["workout_date", "workout_id", "set_number"]
    buckets = ordered.with_range_bucket(df, records.KEYS, order, ranges=16).groupBy("_bucket").count()
    assert buckets.count() == 16 and buckets.agg({"count": "max"}).first()[0] < 300
    best, want = None, []
    for *_, w, n, v in sets:
        if v is not None and (best is None or v > best):
            want.append((w, n, v, best))
            best = v
    found = records.new_records(df, order).collect()
    got = sorted((r.workout_id, r.set_number, r.new_value, r.previous_value) for r in found if r.new_value is not None)
    assert got == want
    flags = {(r.workout_id, r.set_number) for r in records.flag_sets(df, order).collect() if r.is_pr and r.estimated_1rm is not None}
    assert flags == {(w, n) for w, n, *_ in want}


def _sets(spark, athletes, exercises, days):
    return spark.range(athletes * exercises * days).select(
        (F.col("id") % athletes).cast("int").alias("athlete_id"), (F.floor(F.col("id") / athletes) % exercises).cast("int").alias("exercise_id"),
        F.expr("date'2024-01-01' + cast(floor(id / 60) as int)").alias("workout_date"), F.col("id").alias("workout_id"),
        F.lit(1).alias("set_number"), (F.hash("id") % 97).cast("double").alias("estimated_1rm"),
    )


@pytest.mark.parametrize("shape", [(10, 6, 5), (1, 2, 200)])
def test_stored_bests_meet_whole_and_split_keys(spark, shape):
    order = ["workout_date", "workout_id", "set_number"]
    df = _sets(spark, *shape)
    stored = spark.createDataFrame([(0, 0, 50.0), (0, 1, None), (3, 2, 20.0), (7, 7, 1.0)], "athlete_id int, exercise_id long, value double")
    best = {(0, 0): 50.0, (3, 2): 20.0}
    want = {}
    for r in df.orderBy(*order).collect():
        key = (r.athlete_id, r.exercise_id)
        want[r.workout_id] = best.get(key)
        best[key] = max(best.get(key, r.estimated_1rm), r.estimated_1rm)
    got = {r.workout_id: r.previous_pr for r in records.flag_sets(df, order, stored).collect()}
    assert got == want
    records_ = {r.workout_id: r.previous_value for r in records.new_records(df, order, stored).collect()}
    better = {r.workout_id for r in df.collect() if want[r.workout_id] is None or r.estimated_1rm > want[r.workout_id]}
    assert records_ == {k: want[k] for k in better}


def test_a_stored_best_costs_no_summary_of_all_rows(spark):
    order = ["workout_date", "workout_id", "set_number"]
    df = _sets(spark, 10, 6, 5)
    stored = spark.createDataFrame([(0, 0, 50.0)], "athlete_id int, exercise_id int, value double")
    timed, floor = ordered.with_shared_buckets(df, stored.withColumnRenamed("value", "v"), records.KEYS, order)
    assert floor.count() == 1 and timed.count() == 300
    plan = records.flag_sets(df, order, stored)._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Aggregate [")[1:]:
        # What is summed up for the carried bests are the rows of the split keys.
        assert "Filter" in part.split("Join")[0]
