"""Derived silver columns. A column is added only when its inputs exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions import codes
from tiersmith.functions.dates import as_date, iso_year
from tiersmith.functions.numeric import e1rm, number, ratio, rounded, volume
from tiersmith.operators import ordered

# Upper bound (inclusive) and label; the first range starts above 0.
INTENSITY_ZONES = [(7.0, "warm_up"), (8.0, "working"), (9.0, "hard"), (10.0, "max_effort")]
DURATION_RANGES = [(45, "short"), (60, "standard"), (75, "moderate"), (90, "long"), (300, "marathon")]
CALORIES_PER_GRAM = {"protein": 4, "carbs": 4, "fats": 9}


def label_range(value: Column, ranges: list[tuple[float, str]]) -> Column:
    """Label of the left-open, right-closed range a value falls in; null outside all of them."""
    chain = F.when(value <= 0, F.lit(None).cast("string"))
    for upper, name in ranges:
        chain = chain.when(value <= upper, F.lit(name))
    return chain


def add_common(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    if "id" not in df.columns:
        df = df.withColumn("id", F.expr("uuid()"))
    return df.withColumn("_processed_at", F.current_timestamp() if processed_at is None else processed_at)


def exercises(df: DataFrame) -> DataFrame:
    score = F.lit(1)
    if "secondary_muscles" in df.columns:
        score = 1 + F.size(F.coalesce(F.col("secondary_muscles"), F.array().cast("array<string>")))
    df = df.withColumn("compound_score", score)
    if "primary_muscle" in df.columns:
        category = codes.label_of(F.col("primary_muscle"), codes.MOVEMENTS, "other")
        df = df.withColumn("movement_category", category)
    return df


def workouts(df: DataFrame) -> DataFrame:
    have = set(df.columns)
    added: dict[str, Column] = {}
    if "workout_date" in have:
        day = as_date(F.col("workout_date"))
        added["day_of_week"] = F.date_format(day, "EEEE")
        added["week_number"] = F.weekofyear(day)
        added["month"] = F.month(day)
    if {"weight", "reps"} <= have:
        added["set_volume_kg"] = rounded(volume("weight", "reps"), 1)
        added["estimated_1rm"] = e1rm("weight", "reps")
    if "rpe" in have:
        added["intensity_zone"] = label_range(number("rpe"), INTENSITY_ZONES)
    if {"total_volume_kg", "total_sets"} <= have:
        added["volume_per_set"] = rounded(ratio(number("total_volume_kg"), number("total_sets")), 1)
    if "duration_minutes" in have:
        added["duration_category"] = label_range(number("duration_minutes"), DURATION_RANGES)
    return df.withColumns(added) if added else df


def body_composition(df: DataFrame) -> DataFrame:
    if not {"weight_kg", "body_fat_pct"} <= set(df.columns):
        return df
    weight, fat = number("weight_kg"), number("body_fat_pct")
    return df.withColumn("fat_mass_kg", rounded(weight * fat / 100, 1)).withColumn(
        "lean_mass_calc_kg", rounded(weight - F.col("fat_mass_kg"), 1)
    )


def weight_change(
    df: DataFrame, athlete: str = "athlete_id", tie_break: list[str] | None = None
) -> DataFrame:
    """Change against the athlete's previous measurement. Null on the first one."""
    date = next((c for c in ("measured_at", "date") if c in df.columns), None)
    if "weight_kg" not in df.columns or date is None:
        return df
    keys = [athlete] if athlete in df.columns else []
    order = [date, *(tie_break or [c for c in ("id",) if c in df.columns])]
    timed = ordered.with_range_bucket(df, keys, order).withColumn("_weight", number("weight_kg"))
    out = ordered.previous_value(timed, keys, "_bucket", order, "_weight", "_previous")
    change = rounded(F.col("_weight") - F.col("_previous"), 2)
    return out.withColumn("weight_change_kg", change).drop("_bucket", "_weight", "_previous")


def recovery_index(df: DataFrame) -> DataFrame:
    """Mean of the available recovery signals; stress counts inverted. Needs two columns."""
    signals = {
        "sleep_quality": number("sleep_quality"),
        "stress_level": 10 - number("stress_level"),
        "recovery_score": number("recovery_score"),
    }
    parts = [e for c, e in signals.items() if c in df.columns]
    if len(parts) < 2:
        return df
    summed = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    known = sum((p.isNotNull().cast("int") for p in parts[1:]), parts[0].isNotNull().cast("int"))
    return df.withColumn("recovery_index", rounded(F.try_divide(summed, known), 1))


def body_metrics(df: DataFrame) -> DataFrame:
    return df.transform(body_composition).transform(weight_change).transform(recovery_index)


def nutrition(df: DataFrame) -> DataFrame:
    def grams(macro: str) -> Column:
        name = f"{macro}_g"
        return F.coalesce(number(name), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    calories = {m: rounded(grams(m) * k, 0) for m, k in CALORIES_PER_GRAM.items()}
    all_calories = calories["protein"] + calories["carbs"] + calories["fats"]
    added = {f"calories_from_{m}": c for m, c in calories.items()}
    added |= {f"{m}_pct": rounded(F.try_divide(c, all_calories) * 100, 1) for m, c in calories.items()}
    added["total_macros_g"] = rounded(grams("protein") + grams("carbs") + grams("fats"), 1)
    return df.withColumns(added)


DATASETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "exercises": exercises,
    "workouts": workouts,
    "body_metrics": body_metrics,
    "nutrition": nutrition,
}
ENDPOINT_DATASETS = {
    "exercises": "exercises", "muscles": "exercises", "equipment": "exercises",
    "foods_search": "nutrition", "food_detail": "nutrition", "workout_logs": "workouts",
    "body_metrics": "body_metrics", "nutrition_logs": "nutrition",
}


def enrich(df: DataFrame, endpoint: str) -> DataFrame:
    """Route by endpoint; an unknown one only gets the common columns."""
    dataset = ENDPOINT_DATASETS.get(endpoint, endpoint)
    return DATASETS.get(dataset, lambda d: d)(df).transform(add_common)


def iso_week(day: Column, legacy_week: bool = False) -> list[Column]:
    """Grouping columns of a week: ISO year and week, or the bare week number."""
    week = F.weekofyear(day).alias("week")
    return [week] if legacy_week else [iso_year(day).alias("iso_year"), week]
