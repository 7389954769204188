"""The driver tables in the roles the analytics are written for.

orders are workouts, lineitem their sets, part the exercise library, customer the athletes; events
are body measurements as well as nutrition logs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.functions import codes
from tiersmith.functions.text import slug
from tiersmith.session import table

# How the stand-in codes read in the roles.
STATUS = {"F": "completed", "O": "skipped", "P": "partial"}
MEALS = {"signup": "breakfast", "click": "lunch", "purchase": "dinner", "view": "snack"}


def athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("activity_level"),
        F.col("c_acctbal").alias("target_weight_kg"),
    )


def workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("athlete_id"),
        F.col("o_orderdate").cast("date").alias("workout_date"),
        codes.label_of(F.col("o_orderstatus"), STATUS, "planned").alias("status"),
        (F.floor(F.col("o_totalprice") / 2500) + 10).cast("int").alias("duration_minutes"),
        F.col("o_totalprice").alias("total_volume_kg"),
        (level * 2).alias("energy_level"),
        (11 - level * 2).alias("pump_rating"),
        (4.5 + level.cast("double") * 0.5).alias("sleep_hours_prior"),
    )


def workout_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("workout_id"),
        F.col("l_partkey").alias("exercise_id"),
        F.col("l_linenumber").alias("set_number"),
        F.when(F.col("l_returnflag") == "R", "warmup").otherwise("working").alias("set_type"),
        F.col("l_extendedprice").alias("weight_kg"),
        F.col("l_quantity").cast("int").alias("reps"),
        (F.round(F.col("l_tax") * 100).cast("int") + 2).alias("rpe"),
        (F.round(F.col("l_discount") * 100).cast("int") * 30).alias("rest_seconds"),
    )


def brand_code() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")


def exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        slug(F.col("p_name")).alias("slug"),
        codes.label_of(brand_code(), codes.MUSCLES, "full_body").alias("primary_muscle"),
        F.lower("p_type").alias("exercise_type"),
        codes.label_of(F.col("p_size"), codes.EQUIPMENT, "none").alias("equipment"),
        F.lit("intermediate").alias("difficulty"),
        F.concat_ws(" ", "p_type", "p_brand").alias("instructions"),
    )


def _k() -> Column:
    # The property bag holds one number. Filters on columns made of it are pushed below the
    # projection, so it is read in a way that is cheap to repeat.
    return F.regexp_extract("props", r"(\d+)", 1).cast("int")


def body_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    k = F.col("k")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("athlete_id"),
        F.col("ts").alias("measured_at"),
        F.col("value").alias("weight_kg"),
        (k * 0.5).alias("body_fat_pct"),
        (k + 40).alias("resting_heart_rate"),
        (F.floor(k / 10) + 1).cast("int").alias("sleep_quality"),
        (F.floor(k / 12) + 1).cast("int").alias("stress_level"),
        (F.floor(k / 15) + 1).cast("int").alias("recovery_score"),
        (k * 120).alias("steps"),
        F.when(F.col("event_type") == "view", 60 + k).alias("waist_cm"),
        (30 + k * 0.25).alias("left_arm_cm"),
        F.when(F.col("event_type") != "error", 31 + k * 0.125).alias("right_arm_cm"),
    )


def nutrition_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", _k())
    k = F.col("k")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("athlete_id"),
        F.col("ts").cast("date").alias("log_date"),
        # An event type without a meal stays as it is: the contracts have to find it.
        F.coalesce(F.try_element_at(codes.labels(MEALS), F.col("event_type")), "event_type").alias("meal_type"),
        F.col("value").alias("calories"),
        (k * 0.5).alias("protein_g"),
        k.cast("double").alias("carbs_g"),
        (k * 0.25).alias("fats_g"),
        F.when(k >= 5, k * 0.125).alias("fiber_g"),
        (k * 10).alias("water_ml"),
    )


def workout_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per set with athlete, date and exercise name."""
    sets = workout_sets(spark, sf_dir)
    owner = workouts(spark, sf_dir).select(F.col("id").alias("workout_id"), "athlete_id", "workout_date")
    names = exercises(spark, sf_dir).select(F.col("id").alias("exercise_id"), F.col("name").alias("exercise"))
    return (
        sets.join(owner, "workout_id")
        .join(names, "exercise_id")
        .select(
            "athlete_id", "workout_date", "exercise", "set_number",
            F.col("weight_kg").alias("weight"), "reps", "rpe",
        )
    )
