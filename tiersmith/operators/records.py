"""Personal records: every set that beats the athlete's best so far on an exercise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.numeric import e1rm, rounded
from tiersmith.operators.ordered import with_best_before, with_shared_buckets

KEYS = ["athlete_id", "exercise_id"]


def candidate_sets(sets: DataFrame, workouts: DataFrame, exact_single: bool = False) -> DataFrame:
    """Working sets with athlete, date and estimated one-rep maximum.

    A set without athlete, exercise or date cannot hold a record and is left out, so all later joins
    are plain equalities and filters on the keys reach the scans.
    """
    usable = (F.col("set_type") == "working") & F.col("weight_kg").isNotNull() & (F.col("reps") > 0)
    usable &= F.col("exercise_id").isNotNull()
    owner = workouts.select(F.col("id").alias("workout_id"), "athlete_id", "workout_date").dropna()
    return (
        sets.filter(usable)
        .withColumn("estimated_1rm", e1rm("weight_kg", "reps", exact_single))
        .join(owner, "workout_id")
    )


def new_records(candidates: DataFrame, order: list[str], stored: DataFrame | None = None) -> DataFrame:
    """Sets that beat everything before them in ``order`` (a total order that starts with the date).

    ``stored`` holds (athlete_id, exercise_id, value): the records known before. The sets of one athlete and
    exercise are cut into ranges of ``order``, so many sets on one day are several tasks; in a range only sets
    that beat the ranges before it are sorted.
    """
    floor = stored.withColumnRenamed("value", "estimated_1rm") if stored is not None else None
    timed, floor = with_shared_buckets(candidates, floor, KEYS, order)
    ranked = with_best_before(
        timed, KEYS, "_bucket", order, "estimated_1rm", "previous_value", floor, only_better=True,
    )
    new, old = F.col("estimated_1rm"), F.col("previous_value")
    gain = F.when(old > 0, rounded((new - old) / old * 100, 2)).otherwise(100.0)
    return ranked.filter(old.isNull() | (new > old)).select(
        *KEYS,
        "workout_id",
        F.col("workout_date").alias("achieved_date"),
        F.lit("1rm").alias("record_type"),
        new.alias("new_value"),
        "previous_value",
        gain.alias("improvement_pct"),
        *[c for c in order if c not in ("workout_id", "workout_date")],
    )


def matched_sets(sets: DataFrame, workouts: DataFrame, exercises: DataFrame) -> DataFrame:
    """Sets to log with athlete and date, and an ``error`` where one cannot be logged."""
    owner = workouts.select(F.col("id").alias("workout_id"), "athlete_id", "workout_date")
    known = exercises.select(F.col("id").alias("exercise_id"), F.lit(True).alias("_known"))
    found = sets.join(owner, "workout_id", "left").join(known, "exercise_id", "left")
    error = F.when(F.col("_known").isNull(), "exercise not found").when(
        F.col("athlete_id").isNull() | F.col("workout_date").isNull(), "workout not found"
    )
    return found.withColumn("error", error).drop("_known")


def told_apart(matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets that can be logged with their estimate, and the others with their ``error``."""
    found = matched.withColumn("estimated_1rm", e1rm("weight_kg", "reps", exact_single=True))
    return found.filter("error IS NULL").drop("error"), found.filter("error IS NOT NULL")


def logged_sets(sets: DataFrame, workouts: DataFrame, exercises: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sets to log with their estimate, and those that cannot be logged with an ``error``.

    Every type of set is logged; one repetition counts with its own weight. The sets are joined for each reader: store
    what ``matched_sets`` gives and tell it apart where they are read several times.
    """
    return told_apart(matched_sets(sets, workouts, exercises))


def flag_sets(candidates: DataFrame, order: list[str], stored: DataFrame | None = None) -> DataFrame:
    """Every new set with its estimate, the record it met and whether it beat it."""
    floor = stored.withColumnRenamed("value", "estimated_1rm") if stored is not None else None
    timed, floor = with_shared_buckets(candidates, floor, KEYS, order)
    ranked = with_best_before(timed, KEYS, "_bucket", order, "estimated_1rm", "previous_pr", floor)
    beats = F.col("previous_pr").isNull() | (F.col("estimated_1rm") > F.col("previous_pr"))
    return ranked.withColumn("is_pr", F.coalesce(beats, F.lit(False))).drop("_bucket")


def upsert_records(stored: DataFrame, found: DataFrame) -> DataFrame:
    """The record table after a batch: the best of old and new per athlete and exercise."""
    best = found.groupBy(*KEYS).agg(
        F.max("new_value").alias("_value"),
        F.max_by("previous_value", "new_value").alias("_previous"),
        F.max_by("achieved_date", "new_value").alias("_date"),
    )
    value, took = F.col("value"), F.col("_value").isNotNull()
    return stored.join(best, KEYS, "full_outer").select(
        *KEYS,
        F.when(took, F.col("_value")).otherwise(value).alias("value"),
        F.when(took, F.col("_previous")).otherwise(F.col("previous_value")).alias("previous_value"),
        F.when(took, F.col("_date")).otherwise(F.col("achieved_date")).alias("achieved_date"),
    )
