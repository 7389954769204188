"""Nutrition and body analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiersmith.functions.numeric import mean, mean_over, number, ratio, rounded, total
from tiersmith.operators.ordered import moving_mean, with_range_bucket


def daily_nutrition_totals(logs: DataFrame) -> DataFrame:
    def share(grams: str, factor: int) -> Column:
        calories = F.nullif(total("calories"), F.lit(0.0))
        return rounded(total(grams) * factor / calories * 100, 1)

    return logs.groupBy("athlete_id", "log_date").agg(
        total("calories").alias("total_calories"),
        rounded(total("protein_g"), 1).alias("total_protein_g"),
        rounded(total("carbs_g"), 1).alias("total_carbs_g"),
        rounded(total("fats_g"), 1).alias("total_fats_g"),
        rounded(total("fiber_g"), 1).alias("total_fiber_g"),
        F.sum("water_ml").alias("total_water_ml"),
        F.count("*").alias("meals_logged"),
        share("protein_g", 4).alias("protein_pct"),
        share("carbs_g", 4).alias("carbs_pct"),
        share("fats_g", 9).alias("fats_pct"),
    )


def body_composition_weekly(metrics: DataFrame) -> DataFrame:
    """Measurement days (those with a waist value) with fat mass and arm difference."""
    zero = F.lit(0.0)
    arms = F.coalesce(number("right_arm_cm"), zero) - F.coalesce(number("left_arm_cm"), zero)
    return metrics.filter(F.col("waist_cm").isNotNull()).select(
        "athlete_id", "measured_at", "weight_kg", "body_fat_pct",
        rounded(number("weight_kg") * number("body_fat_pct") / 100, 1).alias("fat_mass_kg"),
        "waist_cm", "left_arm_cm", "right_arm_cm",
        rounded(F.abs(arms), 1).alias("arm_difference_cm"),
        "resting_heart_rate", "recovery_score", "steps",
    )


def calories_or_zero() -> Column:
    return F.coalesce(number("calories"), F.lit(0.0))


def calorie_trend(logs: DataFrame, days: int = 7) -> DataFrame:
    """Calories per day with the mean over the last seven days that have entries.

    The window has no key, but it runs over one row per calendar day.
    """
    daily = logs.groupBy("log_date").agg(total(calories_or_zero()).alias("_c"))
    last = Window.orderBy("log_date").rowsBetween(1 - days, 0)
    return daily.select(
        "log_date", rounded("_c", 2).alias("calories"), rounded(mean_over("_c", last), 2).alias("moving_avg")
    )


def macro_split(logs: DataFrame) -> DataFrame:
    sums = {m: F.coalesce(total(f"{m}_g"), F.lit(0.0)) for m in ("protein", "carbs", "fats")}
    grams = sums["protein"] + sums["carbs"] + sums["fats"]
    return logs.agg(
        *[rounded(s, 1).alias(f"{m}_g") for m, s in sums.items()],
        *[rounded(100 * F.try_divide(s, grams), 1).alias(f"{m}_share") for m, s in sums.items()],
    )


def calories_by_meal(logs: DataFrame) -> DataFrame:
    return logs.groupBy("meal_type").agg(rounded(mean(calories_or_zero()), 1).alias("avg_calories"))


def weight_trend(metrics: DataFrame, order: list[str], athletes: list | None = None, rows: int = 7) -> DataFrame:
    """Weight of every measurement with the mean over the athlete's last seven measurements."""
    if athletes is not None:
        metrics = metrics.filter(F.col("athlete_id").isin(athletes))
    series = metrics.select("athlete_id", *order, number("weight_kg").alias("weight_kg"))
    timed = with_range_bucket(series, ["athlete_id"], order)
    out = moving_mean(timed, ["athlete_id"], "_bucket", order, "weight_kg", "_mean", rows)
    return out.withColumn("moving_avg", rounded("_mean", 2)).drop("_bucket", "_mean")


def composition_series(metrics: DataFrame) -> DataFrame:
    weight, fat = number("weight_kg"), number("body_fat_pct")
    fat_mass = rounded(weight * fat / 100, 1)
    return metrics.select(
        "athlete_id", "measured_at", fat_mass.alias("fat_mass_kg"),
        rounded(weight - fat_mass, 1).alias("lean_mass_kg"),
    )


def recovery_series(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "athlete_id", "measured_at", number("recovery_score").alias("recovery"),
        (number("sleep_quality") * 10).alias("sleep_x10"),
    )


def metrics_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(
        F.count("*").alias("days_tracked"),
        rounded(mean("weight_kg"), 1).alias("avg_weight"),
        rounded(F.min("weight_kg"), 1).alias("min_weight"),
        rounded(F.max("weight_kg"), 1).alias("max_weight"),
        rounded(mean("body_fat_pct"), 1).alias("avg_body_fat"),
    )


def meal_summary(logs: DataFrame) -> DataFrame:
    return logs.groupBy("meal_type").agg(
        F.count("*").alias("meals"),
        rounded(mean("calories"), 0).alias("avg_calories"),
        rounded(mean("protein_g"), 0).alias("avg_protein_g"),
    )


def daily_calories(logs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean of the daily calorie sums, overall or per group."""
    by = by or []
    daily = logs.groupBy(*by, "log_date").agg(total("calories").alias("_c"))
    return daily.groupBy(*by).agg(rounded(mean("_c"), 1).alias("avg_daily_calories"))


def nutrition_kpis(logs: DataFrame, metrics: DataFrame, by: list[str]) -> DataFrame:
    """Daily calories and protein, and protein per kilogram of mean body weight."""
    # One row per group and day first: the distinct day count then needs no expansion.
    daily = logs.groupBy(*by, "log_date").agg(
        total("calories").alias("_c"),
        total("protein_g").alias("_p"),
    )
    intake = daily.groupBy(*by).agg(
        ratio(total("_c"), F.count("*")).alias("_calories"), ratio(total("_p"), F.count("*")).alias("_protein")
    )
    weights = metrics.groupBy(*by).agg(mean("weight_kg").alias("_weight"))
    per_kg = F.when(F.col("_weight") > 0, F.col("_protein") / F.col("_weight")).otherwise(0.0)
    return intake.join(weights, by, "left").select(
        *by,
        rounded("_calories", 1).alias("avg_daily_calories"),
        rounded("_protein", 1).alias("avg_daily_protein"),
        rounded(per_kg, 2).alias("protein_per_kg"),
    )


def body_kpis(metrics: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    by = by or []
    return metrics.groupBy(*by).agg(
        rounded(F.max_by("weight_kg", F.struct(*order)), 1).alias("latest_weight"),
        rounded(mean("body_fat_pct"), 1).alias("avg_body_fat"),
        rounded(mean("resting_heart_rate"), 0).alias("avg_resting_hr"),
        rounded(mean("steps"), 0).alias("avg_steps"),
    )
