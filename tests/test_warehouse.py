import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tiersmith.operators import dimensions, records, scd, staging

T0, T1, T2 = ("2023-01-01 00:00:00", "2024-01-01 00:00:00", "2024-06-01 00:00:00")


def at(text):
    return F.lit(text).cast("timestamp")


def frame(spark, data):
    return spark.createDataFrame(data, "slug string, name string, difficulty string")


@pytest.fixture
def first(spark):
    data = [("a", "A", "easy"), ("b", "B", None), ("c", "C", "hard")]
    return scd.first_load(frame(spark, data), at(T0))


def one_current_per_key(df):
    counts = df.filter("is_current").groupBy("slug").count().collect()
    return all(r["count"] == 1 for r in counts)


def test_scd_change_insert_keep(spark, first):
    load = frame(spark, [("a", "A", "medium"), ("b", "B", None), ("d", "D", "easy")])
    out = scd.merge(first, load, ["slug"], ["name", "difficulty"], at(T1)).cache()
    versions = rows(out, "slug", "difficulty", "is_current")
    assert versions == sorted([("a", "easy", False), ("a", "medium", True), ("b", None, True), ("c", "hard", True), ("d", "easy", True)], key=repr)
    closed = out.filter("NOT is_current").first()
    assert closed.effective_to == datetime.datetime(2024, 1, 1)
    assert one_current_per_key(out)
    # The second merge meets history rows; it must only touch current ones.
    again = scd.merge(out, frame(spark, [("a", "A", "hard"), ("b", "B", "easy")]), ["slug"], ["difficulty"], at(T2))
    assert again.count() == 7 and one_current_per_key(again)
    assert again.filter("slug = 'a'").count() == 3


def test_scd_no_change_is_identity(spark, first):
    load = first.select("slug", "name", "difficulty")
    out = scd.merge(first, load, ["slug"], ["name", "difficulty"], at(T1))
    assert rows(out) == rows(first)


def test_scd_duplicate_incoming_keys(spark, first):
    load = frame(spark, [("a", "A", "x"), ("a", "A", "y"), ("e", "E", "x"), ("e", "E", "z")])
    out = scd.merge(first, load, ["slug"], ["difficulty"], at(T1), ["difficulty"])
    assert one_current_per_key(out)
    assert rows(out.filter("is_current AND slug IN ('a', 'e')"), "slug", "difficulty") == [("a", "y"), ("e", "z")]


def test_date_dimension(spark):
    bounds = spark.sql("SELECT '2024-12-30' AS start_date, '2025-01-01' AS end_date")
    got = [r.asDict() for r in dimensions.date_dimension(bounds).orderBy("date_key").collect()]
    assert [g["day_of_week"] for g in got] == [0, 1, 2] and [g["week_of_year"] for g in got] == [1, 1, 1]
    assert got[1]["is_month_end"] and got[2]["is_month_start"] and got[2]["fiscal_quarter"] == 1


def test_dim_and_fact_columns(spark):
    silver = spark.createDataFrame([("x", "chest")], "slug string, primary_muscle string")
    dim = dimensions.exercises(silver, at(T0), ["slug"])
    row = dim.first()
    assert row.name == "Unknown Exercise" and row.secondary_muscles is None and row.is_current
    assert len(dimensions.muscle_groups(spark).collect()) == 19
    log = spark.createDataFrame([("u", "2024-02-03", "oops", 1)], "athlete_id string, log_date string, calories string, junk int")
    fact = dimensions.fact_nutrition(log, ["athlete_id"])
    assert fact.columns == ["id", "athlete_id", "date_key", "log_date", "calories"]
    assert fact.first().date_key == "2024-02-03" and fact.first().calories is None


def test_staged_merge(spark):
    library = spark.createDataFrame(
        [("1", "squat", "Squat", "old", "quads", "compound", "barbell", "hard")],
        "id string, slug string, name string, instructions string, primary_muscle string, exercise_type string, equipment string, difficulty string",
    )
    staged = spark.createDataFrame(
        [(1, "SQUAT", None), (2, "New One", "first"), (3, "new one!", None), (4, "??", "x"), (5, None, "y")],
        "stg_id int, name string, description string",
    )
    merged = staging.merge_exercises(library, staged, ["stg_id"]).cache()
    got = {r.slug: r for r in merged.collect()}
    assert (got["squat"].name, got["squat"].instructions, got["squat"].primary_muscle) == ("SQUAT", "old", "quads")
    assert (got["new-one"].name, got["new-one"].instructions, got["new-one"].primary_muscle) == ("new one!", "first", "full_body")
    assert tuple(staging.merge_counts(merged, staged).first()) == (1, 2, 0, 2)
    audit = {r.target_record_id: r for r in staging.merge_audit(merged, "b1", at(T1)).collect()}
    assert audit["squat"].event_type == "UPDATE" and audit["squat"].old_values == '{"name":"Squat","instructions":"old"}'
    assert audit["new-one"].old_values is None


def test_merging_twice_changes_nothing_also_with_a_null_key(spark):
    load = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    first = scd.first_load(load, F.lit("2024-01-01").cast("timestamp"))
    later = F.lit("2024-02-01").cast("timestamp")
    assert rows(scd.merge(first, load, ["k"], ["v"], later)) == rows(first)
    wider = load.withColumn("w", F.lit("new"))
    once = scd.merge(first, wider, ["k"], ["v", "w"], later)
    assert "w" in once.columns and once.filter("is_current").filter("w = 'new'").count() == 2
    assert rows(scd.merge(once, wider, ["k"], ["v", "w"], later)) == rows(once)


def test_logged_sets_take_every_type_and_name_unknown_exercises(spark):
    sets = spark.createDataFrame(
        [(1, 7, 1, "warmup", 100.0, 1), (1, 7, 2, "working", 90.0, 5), (1, 9, 3, "working", 50.0, 5), (2, 7, 1, "working", 1.0, 1)],
        "workout_id int, exercise_id int, set_number int, set_type string, weight_kg double, reps int",
    )
    workouts = spark.createDataFrame([(1, 5, "2024-01-01")], "id int, athlete_id int, workout_date string").withColumn(
        "workout_date", F.col("workout_date").cast("date")
    )
    known, unknown = records.logged_sets(sets, workouts, spark.createDataFrame([(7,)], "id int"))
    flagged = records.flag_sets(known, ["workout_date", "workout_id", "set_number"])
    assert rows(flagged, "set_number", "estimated_1rm", "previous_pr", "is_pr") == [(1, 100.0, None, True), (2, 105.0, 100.0, True)]
    assert rows(unknown, "set_number", "error") == [(1, "workout not found"), (3, "exercise not found")]
