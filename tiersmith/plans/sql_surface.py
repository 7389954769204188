"""The views and functions under their SQL names, for callers who write SQL.

Views are lazy: a filter on an athlete or exercise in the SQL reaches the scans below. The table
functions select from such views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiersmith.operators import records
from tiersmith.plans import health, training

SET_ORDER = ["workout_date", "workout_id", "set_number", "weight_kg", "reps"]

FUNCTIONS = [
    """CREATE OR REPLACE TEMPORARY FUNCTION calculate_e1rm(weight DOUBLE, reps INT) RETURNS DOUBLE
       RETURN CASE WHEN reps = 1 THEN weight
         ELSE CAST(round(CAST(weight * (1 + reps / 30) AS DECIMAL(38, 8)), 1) AS DOUBLE) END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION get_e1rm_history(athlete BIGINT, exercise_slug STRING)
       RETURNS TABLE (workout_date DATE, best_weight_kg DOUBLE, best_reps INT, estimated_1rm DOUBLE)
       RETURN SELECT workout_date, best_weight_kg, best_reps, estimated_1rm FROM e1rm_histories
         WHERE athlete_id = athlete AND slug = exercise_slug""",
    """CREATE OR REPLACE TEMPORARY FUNCTION calculate_weekly_volume(athlete BIGINT)
       RETURNS TABLE (week_start DATE, total_workouts BIGINT, total_sets BIGINT, total_volume_kg DOUBLE,
         total_reps BIGINT, avg_rpe DOUBLE, muscles_trained ARRAY<STRING>, training_days INT)
       RETURN SELECT week_start, total_workouts, total_sets, total_volume_kg, total_reps, avg_rpe,
         muscles_trained, training_days FROM weekly_volumes WHERE athlete_id = athlete""",
    """CREATE OR REPLACE TEMPORARY FUNCTION detect_new_prs(athlete BIGINT, workout BIGINT)
       RETURNS TABLE (exercise_id BIGINT, record_type STRING, new_value DOUBLE, previous_value DOUBLE,
         improvement_pct DOUBLE)
       RETURN SELECT exercise_id, record_type, new_value, previous_value, improvement_pct FROM new_records
         WHERE athlete_id = athlete AND workout_id = workout""",
]


def views(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    parts = (t["workout_sets"], t["workouts"], t["exercises"])
    candidates = records.candidate_sets(t["workout_sets"], t["workouts"])
    return {
        "weekly_training_summary": training.weekly_training_summary(t["workouts"]),
        "exercise_progression": training.exercise_progression(*parts),
        "daily_nutrition_totals": health.daily_nutrition_totals(t["nutrition_logs"]),
        "body_composition_weekly": health.body_composition_weekly(t["body_metrics"]),
        "muscle_volume_distribution": training.muscle_volume_distribution(*parts),
        "e1rm_histories": training.e1rm_history(*parts),
        "weekly_volumes": training.weekly_volume(*parts),
        "new_records": records.new_records(candidates, SET_ORDER),
    }


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temporary views for the base tables and reports, and the temporary functions on top."""
    for name, df in {**tables, **views(tables)}.items():
        df.createOrReplaceTempView(name)
    for statement in FUNCTIONS:
        spark.sql(statement)
