"""Per-athlete summaries that combine training, body and nutrition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.numeric import mean, number, ratio, rounded, total
from tiersmith.plans.health import daily_calories, daily_nutrition_totals
from tiersmith.plans.training import zero


def training_stats(
    workouts: DataFrame, metrics: DataFrame, logs: DataFrame, records: DataFrame,
    start_date: str, end_date: str, order: list[str], athlete_id=None,
) -> DataFrame:
    """Period overview per athlete (all, or one): sessions, body, nutrition, records hit.

    The first weight may lie after the period and the current one before it: each is bounded on
    one side only.
    """
    start, end = F.lit(start_date).cast("date"), F.lit(end_date).cast("date")
    if athlete_id is not None:
        workouts, metrics, logs, records = (
            d.filter(F.col("athlete_id") == athlete_id) for d in (workouts, metrics, logs, records)
        )

    def within(c: str) -> Column:
        day = F.col(c).cast("date")
        return (day >= start) & (day <= end)

    completed = F.count_if(F.col("status") == "completed")
    sessions = workouts.filter(within("workout_date")).groupBy("athlete_id").agg(
        F.count("*").alias("total_sessions"),
        completed.alias("completed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        rounded(100 * ratio(completed, F.count("*")), 1).alias("completion_rate"),
        rounded(total("duration_minutes") / 60, 1).alias("total_hours"),
        rounded(mean("duration_minutes"), 0).alias("avg_duration_min"),
        rounded(total("total_volume_kg"), 0).alias("total_volume_kg"),
        rounded(mean("energy_level"), 1).alias("avg_energy"),
    )
    day, key = F.col("measured_at").cast("date"), F.struct(*order)
    inside = within("measured_at")
    body = metrics.groupBy("athlete_id").agg(
        F.min_by("weight_kg", F.when(day >= start, key)).alias("start_weight"),
        F.max_by("weight_kg", F.when(day <= end, key)).alias("current_weight"),
        rounded(mean(F.when(inside, F.col("body_fat_pct"))), 1).alias("avg_body_fat"),
        rounded(mean(F.when(inside, F.col("recovery_score"))), 0).alias("avg_recovery"),
    )
    nutrition = daily_nutrition_totals(logs.filter(within("log_date"))).groupBy("athlete_id").agg(
        rounded(mean("total_calories"), 0).alias("avg_calories"),
        rounded(mean("total_protein_g"), 0).alias("avg_protein"),
        rounded(mean("total_carbs_g"), 0).alias("avg_carbs"),
        rounded(mean("total_fats_g"), 0).alias("avg_fats"),
    )
    hits = records.filter(within("achieved_date")).groupBy("athlete_id").agg(F.count("*").alias("prs_hit"))
    joined = reduce(lambda a, b: a.join(b, "athlete_id", "left"), [body, nutrition, hits], sessions)
    return joined.withColumns(
        {"prs_hit": F.coalesce("prs_hit", F.lit(0)), "period_days": F.datediff(end, start)}
    )


def as_document(stats: DataFrame) -> DataFrame:
    """Training stats as one nested JSON document per athlete."""
    workouts = F.struct(
        "total_sessions", "completed", "skipped", "completion_rate", "total_hours",
        "avg_duration_min", "total_volume_kg", "avg_energy",
    )
    body = F.struct("start_weight", "current_weight", "avg_body_fat", "avg_recovery")
    nutrition = F.struct("avg_calories", "avg_protein", "avg_carbs", "avg_fats")
    doc = F.struct(
        F.struct(F.col("period_days").alias("days")).alias("period"), workouts.alias("workouts"),
        body.alias("body"), nutrition.alias("nutrition_avg"), "prs_hit",
    )
    return stats.select("athlete_id", F.to_json(doc, {"ignoreNullFields": "false"}).alias("stats"))


def athlete_cards(log: DataFrame, metrics: DataFrame, logs: DataFrame) -> DataFrame:
    """One card per athlete that appears anywhere, zeros where a part is missing."""
    body = metrics.groupBy("athlete_id").agg(
        rounded(mean("weight_kg"), 1).alias("avg_weight"),
        rounded(mean("body_fat_pct"), 1).alias("avg_body_fat"),
        rounded(mean("resting_heart_rate"), 1).alias("avg_resting_hr"),
        rounded(mean("recovery_score"), 1).alias("avg_recovery"),
    )
    # Per day first, so that the distinct day count needs no second shuffle of the sets.
    per_day = log.groupBy("athlete_id", "workout_date").agg(
        F.count("*").alias("_sets"), total(zero("weight") * zero("reps")).alias("_v")
    )
    training = per_day.groupBy("athlete_id").agg(
        F.sum("_sets").alias("total_sets"),
        F.count("workout_date").alias("training_days"),
        rounded(total("_v"), 1).alias("total_volume"),
    )
    food = daily_calories(logs, ["athlete_id"])
    cards = body.join(training, "athlete_id", "full_outer").join(food, "athlete_id", "full_outer")
    return cards.fillna(0, subset=[c for c in cards.columns if c != "athlete_id"])


def compare_athletes(log: DataFrame, metrics: DataFrame, logs: DataFrame, first, second) -> DataFrame:
    """Key figures of two athletes side by side: (figure, first, second)."""

    def both(df: DataFrame) -> DataFrame:
        return df.filter(F.col("athlete_id").isin(first, second))

    figures = ["avg_weight", "avg_body_fat", "avg_recovery", "total_sets", "avg_daily_calories"]
    cards = athlete_cards(both(log), both(metrics), both(logs)).select(
        "athlete_id", *[number(f).alias(f) for f in figures]
    )
    long = cards.unpivot(["athlete_id"], figures, "figure", "value")

    def value_of(athlete) -> Column:
        return F.coalesce(F.max(F.when(F.col("athlete_id") == athlete, F.col("value"))), F.lit(0.0))

    return long.groupBy("figure").agg(value_of(first).alias("first"), value_of(second).alias("second"))


# Table, date column, days until it counts as stale.
STALE_AFTER = {"workouts": ("workout_date", 7), "body_metrics": ("measured_at", 3), "nutrition_logs": ("log_date", 2)}


def health_summary(tables: dict[str, DataFrame], updated: dict[str, str], as_of: Column) -> DataFrame:
    """Row count, null share, last change and staleness per table.

    ``updated`` names the column that holds the last change. Only the weight of body metrics is
    checked for nulls.
    """
    parts = []
    for name, df in tables.items():
        null_pct = F.lit(0.0)
        if name == "body_metrics":
            missing = F.count("*") - F.count("weight_kg")
            null_pct = F.coalesce(rounded(100 * ratio(missing, F.count("*")), 2), F.lit(0.0))
        status = F.lit("healthy")
        if name in STALE_AFTER:
            day, limit = STALE_AFTER[name]
            stale = F.max(F.col(day).cast("date")) < F.date_sub(as_of.cast("date"), limit)
            status = F.when(stale, "stale").otherwise("healthy")
        parts.append(
            df.agg(
                F.count("*").alias("row_count"),
                null_pct.alias("null_percentage"),
                F.max(F.col(updated[name]).cast("timestamp")).alias("last_updated"),
                status.alias("status"),
            ).withColumn("table_name", F.lit(name))
        )
    return reduce(lambda a, b: a.unionByName(b), parts)
