"""Training analytics over workouts, sets and exercises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.functions.dates import week_start
from tiersmith.functions.numeric import e1rm, mean, number, ratio, rounded, total, volume
from tiersmith.operators.enrich import iso_week

def _working(c: Column | str | None = None) -> Column:
    """The value on working sets, null on others; without an argument the condition itself."""
    is_working = F.col("set_type") == "working"
    if c is None:
        return is_working
    return F.when(is_working, F.col(c) if isinstance(c, str) else c)


def zero(c: str) -> Column:
    return F.coalesce(number(c), F.lit(0.0))


def set_table(sets: DataFrame, workouts: DataFrame, exercises: DataFrame) -> DataFrame:
    """Sets with their workout and exercise columns.

    No broadcast is forced: Spark broadcasts the exercise library while it is below its size
    limit, and shuffles (splitting hot keys at run time) beyond that.
    """
    w = workouts.select(F.col("id").alias("workout_id"), "athlete_id", "workout_date", "status")
    e = exercises.select(F.col("id").alias("exercise_id"), F.col("name").alias("exercise_name"), "slug", "primary_muscle")
    return sets.join(w, "workout_id").join(e, "exercise_id")


def weekly_training_summary(workouts: DataFrame) -> DataFrame:
    return workouts.groupBy("athlete_id", week_start(F.col("workout_date")).alias("week_start")).agg(
        F.count("*").alias("workouts_completed"),
        rounded(mean("duration_minutes"), 0).alias("avg_duration_min"),
        rounded(total("total_volume_kg"), 0).alias("total_weekly_volume_kg"),
        rounded(mean("total_volume_kg"), 0).alias("avg_volume_per_session"),
        rounded(mean("energy_level"), 1).alias("avg_energy"),
        rounded(mean("pump_rating"), 1).alias("avg_pump"),
        rounded(mean("sleep_hours_prior"), 1).alias("avg_sleep_hours"),
        F.count_if(F.col("status") == "skipped").alias("sessions_skipped"),
    )


def exercise_progression(sets: DataFrame, workouts: DataFrame, exercises: DataFrame) -> DataFrame:
    lifted = volume("weight_kg", "reps")
    return (
        set_table(sets, workouts, exercises)
        .groupBy("athlete_id", "exercise_name", "primary_muscle", "workout_date")
        .agg(
            F.count("*").alias("total_sets"),
            F.count_if(_working()).alias("working_sets"),
            rounded(F.max("weight_kg"), 1).alias("max_weight_kg"),
            rounded(mean(_working("weight_kg")), 1).alias("avg_working_weight_kg"),
            rounded(mean(_working("reps")), 1).alias("avg_reps"),
            rounded(mean(_working("rpe")), 1).alias("avg_rpe"),
            rounded(total(_working(lifted)), 0).alias("exercise_volume_kg"),
        )
    )


def muscle_volume_distribution(sets: DataFrame, workouts: DataFrame, exercises: DataFrame) -> DataFrame:
    lifted = volume("weight_kg", "reps")
    done = workouts.filter(F.col("status") == "completed")
    return (
        set_table(sets, done, exercises)
        .groupBy("athlete_id", week_start(F.col("workout_date")).alias("week_start"), "primary_muscle")
        .agg(
            F.count_if(_working()).alias("working_sets"),
            rounded(total(_working(lifted)), 0).alias("total_volume_kg"),
            rounded(mean(_working("rpe")), 1).alias("avg_rpe"),
        )
    )


def weekly_volume(
    sets: DataFrame, workouts: DataFrame, exercises: DataFrame, athlete_id=None, week=None
) -> DataFrame:
    """Weekly volume without warm-ups, for one athlete (and week) or for all.

    The two sets collected per group are bounded: muscle names and the days of one week.
    """
    done = workouts.filter(F.col("status") == "completed")
    if athlete_id is not None:
        done = done.filter(F.col("athlete_id") == athlete_id)
    start = week_start(F.col("workout_date"))
    if week is not None:
        done = done.filter(start == F.lit(week).cast("date"))
    lifted = zero("weight_kg") * zero("reps")
    return (
        set_table(sets.filter(F.col("set_type") != "warmup"), done, exercises)
        .groupBy("athlete_id", start.alias("week_start"))
        .agg(
            F.count_distinct("workout_id").alias("total_workouts"),
            F.count("*").alias("total_sets"),
            rounded(total(lifted), 2).alias("total_volume_kg"),
            F.sum(zero("reps")).cast("bigint").alias("total_reps"),
            rounded(mean("rpe"), 1).alias("avg_rpe"),
            F.sort_array(F.collect_set("primary_muscle")).alias("muscles_trained"),
            F.size(F.collect_set("workout_date")).alias("training_days"),
        )
    )


def e1rm_history(sets: DataFrame, workouts: DataFrame, exercises: DataFrame, slug: str | None = None, athlete_id=None) -> DataFrame:
    """Heaviest working sets per workout and exercise, ties kept.

    The maximum is an aggregate that is joined back, so a hot workout is combined map-side and its
    rows can be split over several tasks.
    """
    working = sets.filter(_working())
    # A choice of exercise or athlete cuts the sets down before anything is aggregated.
    if slug is not None:
        exercises = exercises.filter(F.col("slug") == slug)
        working = working.join(exercises.select(F.col("id").alias("exercise_id")), "exercise_id", "left_semi")
    if athlete_id is not None:
        workouts = workouts.filter(F.col("athlete_id") == athlete_id)
        working = working.join(workouts.select(F.col("id").alias("workout_id")), "workout_id", "left_semi")
    heaviest = working.groupBy("workout_id", "exercise_id").agg(F.max("weight_kg").alias("weight_kg"))
    return set_table(
        working.join(heaviest, ["workout_id", "exercise_id", "weight_kg"]), workouts, exercises
    ).select(
        "athlete_id",
        "slug",
        "workout_id",
        "workout_date",
        F.col("weight_kg").alias("best_weight_kg"),
        F.col("reps").alias("best_reps"),
        e1rm("weight_kg", "reps", exact_single=True).alias("estimated_1rm"),
    )


def update_session_totals(workouts: DataFrame, sets: DataFrame) -> DataFrame:
    """Workouts with volume and non-warm-up set count from their sets; others keep their values."""
    sums = sets.groupBy(F.col("workout_id").alias("id")).agg(
        rounded(total(zero("weight_kg") * zero("reps")), 2).alias("_volume"),
        F.count_if(F.col("set_type") != "warmup").alias("_sets"),
    )
    volume_col = F.coalesce("_volume", "total_volume_kg") if "total_volume_kg" in workouts.columns else F.col("_volume")
    sets_col = F.coalesce("_sets", "total_sets") if "total_sets" in workouts.columns else F.col("_sets")
    return (
        workouts.join(sums, "id", "left")
        .withColumns({"total_volume_kg": volume_col, "total_sets": sets_col})
        .drop("_volume", "_sets")
    )


def workout_detail(
    workouts: DataFrame, sets: DataFrame, exercises: DataFrame, tags: DataFrame | None = None,
) -> DataFrame:
    """Per workout one nested JSON document: session, exercises by first set, their sets, tags."""
    keep = {"ignoreNullFields": "false"}
    one_set = F.struct("set_number", "set_type", "weight_kg", "reps", "rpe", "rest_seconds")
    per_exercise = sets.groupBy("workout_id", "exercise_id").agg(
        F.min("set_number").alias("first_set"), F.sort_array(F.collect_list(one_set)).alias("sets")
    )
    named = per_exercise.join(
        exercises.select(
            F.col("id").alias("exercise_id"), F.col("name").alias("exercise_name"),
            F.col("primary_muscle").alias("muscle_group"), "equipment",
        ),
        "exercise_id",
    )
    block = F.struct("first_set", "exercise_id", "exercise_name", "muscle_group", "equipment", "sets")
    per_workout = named.groupBy("workout_id").agg(F.sort_array(F.collect_list(block)).alias("_blocks"))
    blocks = F.transform(
        "_blocks",
        lambda b: F.struct(b["exercise_name"].alias("exercise_name"), b["muscle_group"].alias("muscle_group"),
                           b["equipment"].alias("equipment"), b["sets"].alias("sets")),
    )
    session = ["id", "workout_date", "status", "duration_minutes", "total_volume_kg", "energy_level", "pump_rating"]
    docs = workouts.select(*session).join(per_workout.withColumnRenamed("workout_id", "id"), "id", "left")
    if tags is not None:
        named_tags = tags.groupBy(F.col("workout_id").alias("id")).agg(
            F.sort_array(F.collect_set("name")).alias("tags")
        )
        docs = docs.join(named_tags, "id", "left")
    else:
        docs = docs.withColumn("tags", F.lit(None).cast("array<string>"))
    return docs.select(
        F.col("id").alias("workout_id"),
        F.to_json(F.struct(*session), keep).alias("workout"),
        F.to_json(blocks, keep).alias("exercises"),
        F.to_json("tags").alias("tags"),
    )


# ---- charts and tables over the workout log (athlete_id, workout_date, exercise, weight, reps) ----


def _lifted() -> Column:
    return zero("weight") * zero("reps")


def e1rm_trend(log: DataFrame, exercise: str) -> DataFrame:
    return (
        log.filter(F.col("exercise") == exercise)
        .groupBy("workout_date")
        .agg(F.max(e1rm("weight", "reps")).alias("best_e1rm"))
    )


def volume_by_week(log: DataFrame, legacy_week: bool = False) -> DataFrame:
    """Volume per ISO week; ``legacy_week`` merges the same week of different years."""
    weeks = iso_week(F.col("workout_date"), legacy_week)
    return log.groupBy(*weeks).agg(rounded(total(_lifted()), 1).alias("volume_kg"))


def muscle_lookup(exercises: DataFrame) -> DataFrame:
    """Exercise name -> muscle; of several exercises with one name the last id counts."""
    return exercises.groupBy(F.col("name").alias("exercise")).agg(F.max_by("primary_muscle", "id").alias("muscle"))


def volume_by_muscle(log: DataFrame, exercises: DataFrame, drop_other: bool = False) -> DataFrame:
    # Summing per exercise first leaves one row per exercise name to join.
    per_exercise = log.groupBy("exercise").agg(total(_lifted()).alias("_v"))
    out = (
        per_exercise.join(muscle_lookup(exercises), "exercise", "left")
        .groupBy(F.coalesce("muscle", F.lit("other")).alias("muscle"))
        .agg(rounded(total("_v"), 1).alias("volume_kg"))
    )
    return out.filter(F.col("muscle") != "other") if drop_other else out


def sessions_per_week(log: DataFrame, legacy_week: bool = False) -> DataFrame:
    """Distinct training days per ISO week."""
    weeks = iso_week(F.col("workout_date"), legacy_week)
    return log.groupBy(*weeks).agg(F.count_distinct("workout_date").alias("sessions"))


def overview(log: DataFrame) -> DataFrame:
    """Key figures of the whole log in one row.

    Tasks reduce their rows to the distinct athletes, days and exercises they hold before anything
    is shuffled.
    """
    volume_kg = total(_lifted())
    return log.agg(
        rounded(volume_kg, 1).alias("total_volume_kg"),
        F.count_distinct("athlete_id").alias("athletes"),
        F.count_distinct("workout_date").alias("training_days"),
        F.count_distinct("exercise").alias("exercises"),
        F.count("*").alias("total_sets"),
        F.coalesce(rounded(ratio(volume_kg, F.count("*")), 1), F.lit(0.0)).alias("avg_volume_per_set"),
    )


def top_performer(log: DataFrame, athletes: DataFrame) -> DataFrame:
    best = (
        log.groupBy("athlete_id")
        .agg(rounded(total(_lifted()), 1).alias("volume_kg"))
        .orderBy(F.desc("volume_kg"), "athlete_id")
        .limit(1)
    )
    names = athletes.select(F.col("id").alias("athlete_id"), "full_name")
    handle = F.initcap(F.replace(F.split(F.col("athlete_id").cast("string"), "@")[0], F.lit("."), F.lit(" ")))
    return best.join(names, "athlete_id", "left").select(
        "athlete_id", F.coalesce("full_name", handle).alias("full_name"), "volume_kg"
    )


def record_table(log: DataFrame) -> DataFrame:
    return log.groupBy("exercise").agg(
        F.max(rounded(zero("weight") * (1 + zero("reps") / 30), 1)).alias("best_e1rm"),
        F.max(zero("weight")).alias("heaviest"),
        F.max(zero("reps")).alias("max_reps"),
        F.count("*").alias("total_sets"),
    )


def exercise_breakdown(log: DataFrame) -> DataFrame:
    return log.groupBy("exercise").agg(
        F.count("*").alias("total_sets"),
        rounded(mean(zero("weight")), 1).alias("avg_weight"),
        rounded(mean(zero("reps")), 1).alias("avg_reps"),
        rounded(total(_lifted()), 1).alias("total_volume"),
    )


def consistency(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Span, training days, rest days and sessions per week, overall or per group."""
    by = by or []
    days = log.filter(F.col("workout_date").isNotNull()).select(*by, "workout_date").distinct()
    span = F.when(F.count("*") > 1, F.datediff(F.max("workout_date"), F.min("workout_date")) + 1).otherwise(1)
    figures = days.groupBy(*by).agg(span.alias("total_days"), F.count("*").alias("training_days"))
    weeks = F.greatest(F.col("total_days") / 7, F.lit(1.0))
    return figures.withColumns(
        {
            "rest_days": F.col("total_days") - F.col("training_days"),
            "sessions_per_week": rounded(F.col("training_days") / weeks, 2),
        }
    )


def best_streak(log: DataFrame, by: list[str] | None = None, max_gap: int = 2) -> DataFrame:
    """Longest run of training days with gaps of at most ``max_gap`` days; 0 for a single day.

    Runs over distinct days, at most one row per calendar day and group.
    """
    by = by or []
    days = log.filter(F.col("workout_date").isNotNull()).select(*by, "workout_date").distinct()
    in_time = Window.partitionBy(*by).orderBy("workout_date")
    gap = F.datediff(F.col("workout_date"), F.lag("workout_date").over(in_time))
    runs = (
        days.withColumn("_starts", F.when(gap <= max_gap, 0).otherwise(1))
        .withColumn("_run", F.sum("_starts").over(in_time))
        .groupBy(*by, "_run")
        .agg(F.count("*").alias("_days"))
    )
    longest = F.when(F.sum("_days") > 1, F.max("_days")).otherwise(0)
    return runs.groupBy(*by).agg(longest.cast("bigint").alias("best_streak"))


def compare_weekly_volume(log: DataFrame, first, second) -> DataFrame:
    weeks = iso_week(F.col("workout_date"))
    two = log.filter(F.col("athlete_id").isin(first, second))

    def volume_of(athlete) -> Column:
        return rounded(total(F.when(F.col("athlete_id") == athlete, _lifted())), 1)

    return two.groupBy(*weeks).agg(
        volume_of(first).alias("volume_first"), volume_of(second).alias("volume_second")
    )


def compare_strength(log: DataFrame, first, second) -> DataFrame:
    """Exercises both athletes do: best estimate of each and the difference."""
    estimate = number("weight") * (1 + number("reps") / 30)

    def of(athlete, c: Column) -> Column:
        return F.when(F.col("athlete_id") == athlete, c)

    a, b = F.max(of(first, estimate)), F.max(of(second, estimate))
    return (
        log.filter(F.col("athlete_id").isin(first, second))
        .groupBy("exercise")
        .agg(
            rounded(a, 1).alias("e1rm_first"),
            rounded(b, 1).alias("e1rm_second"),
            rounded(a - b, 1).alias("difference"),
            F.count(of(first, F.lit(1))).alias("_a"),
            F.count(of(second, F.lit(1))).alias("_b"),
        )
        .filter((F.col("_a") > 0) & (F.col("_b") > 0))
        .drop("_a", "_b")
    )
