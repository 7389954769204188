import datetime

import pytest

from tests.conftest import rows
from tiersmith.functions.numeric import e1rm
from tiersmith.operators import enrich, transforms

EXERCISES = [
    (1, "Bench Press!", "press", [5, 6, 99], [1], 11),
    (2, " Plank  hold ", None, [], [], 10),
    (3, "Calf-Raise", None, None, [42], 14),
]
EXERCISE_SCHEMA = "id long, name string, description string, muscles array<int>, equipment array<int>, category int"


def test_exercise_library(spark):
    out = transforms.transform(spark.createDataFrame(EXERCISES, EXERCISE_SCHEMA), "exercise_api", "exercises")
    got = {r.source_id: r for r in out.collect()}
    assert [got[i].primary_muscle for i in (1, 2, 3)] == ["chest", "full_body", "full_body"]
    assert [got[i].secondary_muscles for i in (1, 2, 3)] == [["triceps", "unknown"], [], []]
    assert [got[i].equipment for i in (1, 2, 3)] == ["barbell", "none", "none"]
    assert [got[i].slug for i in (1, 2, 3)] == ["bench-press", "plank-hold", "calfraise"]
    assert [got[i].exercise_type for i in (1, 2, 3)] == ["compound", "compound", "cardio"]
    enriched = {r.source_id: r for r in enrich.exercises(out).collect()}
    assert [enriched[i].compound_score for i in (1, 2, 3)] == [3, 1, 1]
    assert enriched[1].movement_category == "upper_body_push"


def test_category_struct(spark):
    df = spark.createDataFrame([(1, (14, "Calves"))], "id int, category struct<id:int,name:string>")
    assert transforms.exercise_library(df).first().exercise_type == "cardio"


def test_reference_names(spark):
    df = spark.createDataFrame([(1, "Bizeps", "Biceps")], "id int, name string, name_en string")
    assert rows(transforms.reference_names(df)) == [(1, "Biceps")]
    other = spark.createDataFrame([(1, "x")], "id int, full_name string")
    assert transforms.reference_names(other).columns == ["id", "name"]


def test_nutrients_by_either_id_and_value(spark):
    schema = "fdc_id long, description string, food_nutrients array<struct<nutrientId:int,nutrient:struct<id:int>,value:double,amount:double>>"
    items = [(1003, None, 5.0, None), (None, (1005,), None, 7.0), (1003, None, 6.0, None), (9, None, 1.0, None)]
    df = spark.createDataFrame([(1, "oats", items), (2, "air", None)], schema)
    got = {r.usda_fdc_id: r for r in transforms.food_search(df).collect()}
    assert (got[1].protein_g, got[1].carbs_g, got[1].calories) == (6.0, 7.0, None)
    assert got[2].food_name == "air" and got[2].protein_g is None


def test_pounds_and_inches(spark):
    df = spark.createDataFrame([(220.0, "LBS"), (100.0, "kg"), (80.0, None)], "weight double, weight_unit string")
    out = transforms.workout_file(df).collect()
    assert [round(r.weight, 4) for r in out] == [99.7902, 100.0, 80.0] and {r.weight_unit for r in out} == {"kg"}
    body = spark.createDataFrame([("32", "x", 1)], "waist_in string, chest_inches string, _ingested_at int")
    out = transforms.body_metric_file(body)
    assert sorted(out.columns) == ["_ingested_at", "chest_cm", "waist_cm"]
    assert out.first().waist_cm == pytest.approx(81.28) and out.first().chest_cm is None


def test_dates_and_map_columns(spark):
    df = spark.createDataFrame([("2024-03-01", "a"), ("soon", "b")], "date string, athlete_email string")
    parsed = transforms.nutrition_file(df)
    assert [r.date for r in parsed.collect()] == [datetime.date(2024, 3, 1), None]
    mapped = transforms.map_columns(parsed, {"date": "workout_date", "gone": "x"}, {"status": "completed"})
    assert mapped.columns == ["workout_date", "athlete_email", "status"]


def test_unknown_routes_pass_through(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert transforms.transform(df, "nobody", "nothing").columns == ["x"]
    assert enrich.enrich(df, "nothing").columns == ["x", "id", "_processed_at"]


def test_workout_enrichment(spark):
    df = spark.createDataFrame(
        [("2024-12-30", 100.0, 8, 7.0, 45), ("bad", 100.0, 1, 10.5, 301)],
        "workout_date string, weight double, reps int, rpe double, duration_minutes int",
    )
    a, b = enrich.workouts(df).collect()
    assert (a.day_of_week, a.week_number, a.month) == ("Monday", 1, 12)
    assert (a.set_volume_kg, a.estimated_1rm, a.intensity_zone, a.duration_category) == (800.0, 126.7, "warm_up", "short")
    assert (b.day_of_week, b.intensity_zone, b.duration_category) == (None, None, None)
    single = df.select(e1rm("weight", "reps", exact_single=True).alias("e")).collect()
    assert [r.e for r in single] == [126.7, 100.0] and b.estimated_1rm == 103.3


def test_body_enrichment(spark):
    df = spark.createDataFrame(
        [(1, "a", "2024-01-01 08:00:00", 80.5, 11.2, 8, 3, 7), (2, "a", "2024-01-02 08:00:00", 80.0, None, None, 4, 6),
         (3, "b", "2024-01-02 09:00:00", 60.0, 20.0, None, None, 5)],
        "id int, athlete_id string, measured_at string, weight_kg double, body_fat_pct double, sleep_quality int, stress_level int, recovery_score int",
    ).selectExpr("* except(measured_at)", "cast(measured_at as timestamp) as measured_at")
    got = {r.id: r for r in enrich.body_metrics(df).collect()}
    assert (got[1].fat_mass_kg, got[1].lean_mass_calc_kg) == (9.0, 71.5)
    assert [got[i].weight_change_kg for i in (1, 2, 3)] == [None, -0.5, None]
    assert [got[i].recovery_index for i in (1, 2, 3)] == [7.3, 6.0, 5.0]


def test_nutrition_enrichment(spark):
    df = spark.createDataFrame([(25.0, 50.0, 10.0), (0.0, None, 0.0)], "protein_g double, carbs_g double, fats_g double")
    a, b = enrich.nutrition(df).collect()
    assert (a.calories_from_protein, a.calories_from_carbs, a.calories_from_fats) == (100.0, 200.0, 90.0)
    assert (a.protein_pct, a.carbs_pct, a.fats_pct, a.total_macros_g) == (25.6, 51.3, 23.1, 85.0)
    assert (b.protein_pct, b.total_macros_g) == (None, 0.0)
