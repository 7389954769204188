"""Queries behind the dashboard charts and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import avg, dsum, epley, rnd, tot, with_roles
from tiersmith.plans import athletes, health, roles, training

# Parameters of the reports.
EXERCISE = "hot bolt"
FIRST, SECOND = 1, 2
ORDER = ["measured_at", "id"]
ISO = "CAST(isoyear(workout_date) AS INTEGER) AS iso_year, CAST(week(workout_date) AS INTEGER) AS week"
VOLUME = "weight * reps"


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.workout_log(spark, sf_dir)


@query(
    "H1_e1rm_trend",
    with_roles(
        "workout_log",
        f"""SELECT workout_date, MAX({epley("weight", "reps")}) AS best_e1rm FROM workout_log
            WHERE exercise = '{EXERCISE}' GROUP BY workout_date""",
    ),
)
def e1rm_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.e1rm_trend(log(spark, sf_dir), EXERCISE)


@query(
    "H2_weekly_volume",
    with_roles("workout_log", f"SELECT {ISO}, {rnd(dsum(VOLUME), 1)} AS volume_kg FROM workout_log GROUP BY ALL"),
)
def weekly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.volume_by_week(log(spark, sf_dir))


@query(
    "H2_weekly_volume_without_year",
    with_roles(
        "workout_log",
        f"SELECT CAST(week(workout_date) AS INTEGER) AS week, {rnd(dsum(VOLUME), 1)} AS volume_kg FROM workout_log GROUP BY ALL",
    ),
)
def weekly_volume_without_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.volume_by_week(log(spark, sf_dir), legacy_week=True)


def _muscle_sql(where: str) -> str:
    return with_roles(
        "workout_log",
        f"""SELECT coalesce(muscle, 'other') AS muscle, {rnd(dsum(VOLUME), 1)} AS volume_kg
            FROM workout_log LEFT JOIN lookup USING (exercise) {where} GROUP BY ALL""",
        lookup="""SELECT name AS exercise, arg_max(primary_muscle, id) AS muscle FROM exercises GROUP BY name""",
    )


@query("H3_volume_by_muscle", _muscle_sql(""))
def volume_by_muscle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.volume_by_muscle(log(spark, sf_dir), roles.exercises(spark, sf_dir))


@query("H11_muscle_balance", _muscle_sql("WHERE muscle IS NOT NULL"))
def muscle_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.volume_by_muscle(log(spark, sf_dir), roles.exercises(spark, sf_dir), drop_other=True)


@query(
    "H4_calorie_trend",
    with_roles(
        "nutrition_logs",
        f"""SELECT log_date, {rnd("c", 2)} AS calories, {rnd("""CAST(SUM(CAST(c AS DECIMAL(28,6))) OVER (ORDER BY log_date ROWS BETWEEN 6
            PRECEDING AND CURRENT ROW) AS DOUBLE) / COUNT(*) OVER (ORDER BY log_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", 2)}
            AS moving_avg FROM (SELECT log_date, SUM(CAST(calories AS DECIMAL(28,6))) AS c FROM nutrition_logs GROUP BY log_date)""",
    ),
)
def calorie_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.calorie_trend(roles.nutrition_logs(spark, sf_dir))


SHARE = f"({tot('protein_g')} + {tot('carbs_g')} + {tot('fats_g')})"


@query(
    "H5_macro_split",
    with_roles(
        "nutrition_logs",
        "SELECT " + ", ".join(
            f"{rnd(dsum(f'{m}_g'), 1)} AS {m}_g, {rnd(f'100 * ({tot(f'{m}_g')} / {SHARE})', 1)} AS {m}_share"
            for m in ("protein", "carbs", "fats")
        ) + " FROM nutrition_logs",
    ),
)
def macro_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.macro_split(roles.nutrition_logs(spark, sf_dir))


@query(
    "H6_calories_by_meal",
    with_roles(
        "nutrition_logs",
        f"SELECT meal_type, {rnd(avg('calories'), 1)} AS avg_calories FROM nutrition_logs GROUP BY meal_type",
    ),
)
def calories_by_meal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.calories_by_meal(roles.nutrition_logs(spark, sf_dir)).orderBy(F.desc("avg_calories"))


def _weight_sql(where: str) -> str:
    frame = "OVER (PARTITION BY athlete_id ORDER BY measured_at, id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    mean = f"SUM(CAST(weight_kg AS DECIMAL(28,6))) {frame} / COUNT(weight_kg) {frame}"
    return with_roles(
        "body_metrics",
        f"SELECT athlete_id, measured_at, id, weight_kg, {rnd(mean, 2)} AS moving_avg FROM body_metrics {where}",
    )


@query("H7_weight_trend", _weight_sql(""))
def weight_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.weight_trend(roles.body_metrics(spark, sf_dir), ORDER)


@query("H12_compare_weight", _weight_sql(f"WHERE athlete_id IN ({FIRST}, {SECOND})"))
def compare_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.weight_trend(roles.body_metrics(spark, sf_dir), ORDER, [FIRST, SECOND])


FAT = rnd("weight_kg * body_fat_pct / 100", 1)


@query(
    "H8_composition_series",
    with_roles(
        "body_metrics",
        f"""SELECT athlete_id, measured_at, {FAT} AS fat_mass_kg, {rnd(f"weight_kg - {FAT}", 1)} AS lean_mass_kg
            FROM body_metrics""",
    ),
)
def composition_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.composition_series(roles.body_metrics(spark, sf_dir))


@query(
    "H9_recovery_series",
    with_roles(
        "body_metrics",
        """SELECT athlete_id, measured_at, CAST(recovery_score AS DOUBLE) AS recovery,
           CAST(sleep_quality * 10 AS DOUBLE) AS sleep_x10 FROM body_metrics""",
    ),
)
def recovery_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.recovery_series(roles.body_metrics(spark, sf_dir))


@query(
    "H10_sessions_per_week",
    with_roles("workout_log", f"SELECT {ISO}, COUNT(DISTINCT workout_date) AS sessions FROM workout_log GROUP BY ALL"),
)
def sessions_per_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.sessions_per_week(log(spark, sf_dir))


@query(
    "H13_compare_weekly_volume",
    with_roles(
        "workout_log",
        f"""SELECT {ISO}, {rnd(dsum(f"CASE WHEN athlete_id = {FIRST} THEN {VOLUME} END"), 1)} AS volume_first,
            {rnd(dsum(f"CASE WHEN athlete_id = {SECOND} THEN {VOLUME} END"), 1)} AS volume_second
            FROM workout_log WHERE athlete_id IN ({FIRST}, {SECOND}) GROUP BY ALL""",
    ),
)
def compare_weekly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.compare_weekly_volume(log(spark, sf_dir), FIRST, SECOND)


@query(
    "H14_overview",
    with_roles(
        "workout_log",
        f"""SELECT {rnd(dsum(VOLUME), 1)} AS total_volume_kg, COUNT(DISTINCT athlete_id) AS athletes,
            COUNT(DISTINCT workout_date) AS training_days, COUNT(DISTINCT exercise) AS exercises, COUNT(*) AS total_sets,
            {rnd(f"{tot(VOLUME)} / COUNT(*)", 1)} AS avg_volume_per_set FROM workout_log""",
    ),
)
def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.overview(log(spark, sf_dir))


def _daily(by: str = "") -> str:
    return f"""SELECT {by} log_date, SUM(CAST(calories AS DECIMAL(28,6))) AS c, SUM(CAST(protein_g AS DECIMAL(28,6))) AS p
        FROM nutrition_logs GROUP BY {by} log_date"""


@query(
    "H15_avg_daily_calories",
    with_roles(
        "nutrition_logs",
        f"SELECT {rnd('CAST(SUM(CAST(c AS DECIMAL(28,6))) AS DOUBLE) / COUNT(c)', 1)} AS avg_daily_calories FROM daily",
        daily=_daily(),
    ),
)
def avg_daily_calories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.daily_calories(roles.nutrition_logs(spark, sf_dir))


@query(
    "H16_top_performer",
    with_roles(
        "workout_log athletes",
        f"""SELECT athlete_id, full_name, volume_kg FROM (SELECT athlete_id, {rnd(dsum(VOLUME), 1)} AS volume_kg
            FROM workout_log GROUP BY athlete_id ORDER BY volume_kg DESC, athlete_id LIMIT 1) t
            JOIN athletes a ON a.id = t.athlete_id""",
    ),
)
def top_performer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.top_performer(log(spark, sf_dir), roles.athletes(spark, sf_dir))


@query(
    "H17_record_table",
    with_roles(
        "workout_log",
        f"""SELECT exercise, MAX({epley("weight", "reps")}) AS best_e1rm, MAX(weight) AS heaviest,
            CAST(MAX(reps) AS DOUBLE) AS max_reps, COUNT(*) AS total_sets FROM workout_log GROUP BY exercise""",
    ),
)
def record_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.record_table(log(spark, sf_dir)).orderBy(F.desc("best_e1rm"))


@query(
    "H18_nutrition_kpis",
    with_roles(
        "nutrition_logs body_metrics",
        f"""SELECT athlete_id, {rnd("c", 1)} AS avg_daily_calories, {rnd("p", 1)} AS avg_daily_protein,
            {rnd("CASE WHEN w > 0 THEN p / w ELSE 0 END", 2)} AS protein_per_kg FROM (
              SELECT athlete_id, CAST(SUM(CAST(c AS DECIMAL(28,6))) AS DOUBLE) / COUNT(*) AS c, CAST(SUM(CAST(p AS DECIMAL(28,6))) AS DOUBLE) / COUNT(*) AS p
              FROM daily GROUP BY athlete_id) LEFT JOIN (
              SELECT athlete_id, {avg("weight_kg")} AS w FROM body_metrics GROUP BY athlete_id) USING (athlete_id)""",
        daily=_daily("athlete_id,"),
    ),
)
def nutrition_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.nutrition_kpis(roles.nutrition_logs(spark, sf_dir), roles.body_metrics(spark, sf_dir), ["athlete_id"])


@query(
    "H19_body_kpis",
    with_roles(
        "body_metrics",
        f"""SELECT athlete_id, {rnd("arg_max(weight_kg, (measured_at, id))", 1)} AS latest_weight,
            {rnd(avg("body_fat_pct"), 1)} AS avg_body_fat, {rnd(avg("resting_heart_rate"), 0)} AS avg_resting_hr,
            {rnd(avg("steps"), 0)} AS avg_steps FROM body_metrics GROUP BY athlete_id""",
    ),
)
def body_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.body_kpis(roles.body_metrics(spark, sf_dir), ORDER, ["athlete_id"])


def _consistency_sql(by: str) -> str:
    group = f"GROUP BY {by[:-1]}" if by else ""
    return with_roles(
        "workout_log",
        f"""SELECT *, total_days - training_days AS rest_days,
            {rnd("training_days / greatest(CAST(total_days AS DOUBLE) / 7, 1)", 2)} AS sessions_per_week FROM (
              SELECT {by} CAST(CASE WHEN COUNT(*) > 1 THEN date_diff('day', MIN(workout_date), MAX(workout_date)) + 1 ELSE 1 END
                AS INTEGER) AS total_days, COUNT(*) AS training_days
              FROM (SELECT DISTINCT {by} workout_date FROM workout_log) {group})""",
    )


@query("H20_consistency", _consistency_sql(""))
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.consistency(log(spark, sf_dir))


@query("H20_consistency_by_athlete", _consistency_sql("athlete_id,"))
def consistency_by_athlete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.consistency(log(spark, sf_dir), ["athlete_id"])


def _streak_sql(by: str, gap: int) -> str:
    partition = f"PARTITION BY {by[:-1]}" if by else ""
    group = f"GROUP BY {by[:-1]}" if by else ""
    return with_roles(
        "workout_log",
        f"""SELECT {by} CAST(CASE WHEN SUM(n) > 1 THEN MAX(n) ELSE 0 END AS BIGINT) AS best_streak FROM (
              SELECT {by} run, COUNT(*) AS n FROM (
                SELECT {by} SUM(starts) OVER ({partition} ORDER BY workout_date) AS run FROM (
                  SELECT {by} workout_date, CASE WHEN date_diff('day', lag(workout_date) OVER ({partition} ORDER BY workout_date),
                    workout_date) <= {gap} THEN 0 ELSE 1 END AS starts
                  FROM (SELECT DISTINCT {by} workout_date FROM workout_log))) GROUP BY {by} run) {group}""",
    )


@query("H21_best_streak", _streak_sql("", 2))
def best_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.best_streak(log(spark, sf_dir))


@query("H21_best_streak_by_athlete", _streak_sql("athlete_id,", 60))
def best_streak_by_athlete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workouts of one athlete are weeks apart in this data, hence the wide gap."""
    return training.best_streak(log(spark, sf_dir), ["athlete_id"], max_gap=60)


@query(
    "H22_exercise_breakdown",
    with_roles(
        "workout_log",
        f"""SELECT exercise, COUNT(*) AS total_sets, {rnd(avg("weight"), 1)} AS avg_weight, {rnd(avg("reps"), 1)} AS avg_reps,
            {rnd(dsum(VOLUME), 1)} AS total_volume FROM workout_log GROUP BY exercise""",
    ),
)
def exercise_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.exercise_breakdown(log(spark, sf_dir)).orderBy(F.desc("total_volume"))


CARDS = {
    "body": f"""SELECT athlete_id, {rnd(avg("weight_kg"), 1)} AS avg_weight, {rnd(avg("body_fat_pct"), 1)} AS avg_body_fat,
        {rnd(avg("resting_heart_rate"), 1)} AS avg_resting_hr, {rnd(avg("recovery_score"), 1)} AS avg_recovery
        FROM body_metrics GROUP BY athlete_id""",
    "lifts": f"""SELECT athlete_id, COUNT(*) AS total_sets, COUNT(DISTINCT workout_date) AS training_days,
        {rnd(dsum(VOLUME), 1)} AS total_volume FROM workout_log GROUP BY athlete_id""",
    "daily": _daily("athlete_id,"),
    "food": f"SELECT athlete_id, {rnd('CAST(SUM(CAST(c AS DECIMAL(28,6))) AS DOUBLE) / COUNT(c)', 1)} AS avg_daily_calories FROM daily GROUP BY athlete_id",
    "cards": """SELECT athlete_id, coalesce(avg_weight, 0) AS avg_weight, coalesce(avg_body_fat, 0) AS avg_body_fat,
        coalesce(avg_resting_hr, 0) AS avg_resting_hr, coalesce(avg_recovery, 0) AS avg_recovery,
        coalesce(total_sets, 0) AS total_sets, coalesce(training_days, 0) AS training_days,
        coalesce(total_volume, 0) AS total_volume, coalesce(avg_daily_calories, 0) AS avg_daily_calories
        FROM body FULL JOIN lifts USING (athlete_id) FULL JOIN food USING (athlete_id)""",
}
ALL_ROLES = "workout_log body_metrics nutrition_logs"


@query(
    "H23_compare_athletes",
    with_roles(
        ALL_ROLES,
        " UNION ALL ".join(
            f"""SELECT '{f}' AS figure, coalesce(MAX(CASE WHEN athlete_id = {FIRST} THEN {f} END), 0) AS first,
            coalesce(MAX(CASE WHEN athlete_id = {SECOND} THEN {f} END), 0) AS second FROM cards"""
            for f in ("avg_weight", "avg_body_fat", "avg_recovery", "total_sets", "avg_daily_calories")
        ),
        **CARDS,
    ),
)
def compare_athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return athletes.compare_athletes(
        log(spark, sf_dir), roles.body_metrics(spark, sf_dir), roles.nutrition_logs(spark, sf_dir), FIRST, SECOND
    )


@query(
    "H24_compare_strength",
    with_roles(
        "workout_log",
        f"""SELECT exercise, {rnd("a", 1)} AS e1rm_first, {rnd("b", 1)} AS e1rm_second, {rnd("a - b", 1)} AS difference
            FROM (SELECT exercise, MAX(weight * (1 + CAST(reps AS DOUBLE) / 30)) FILTER (WHERE athlete_id = {FIRST}) AS a,
              MAX(weight * (1 + CAST(reps AS DOUBLE) / 30)) FILTER (WHERE athlete_id = {SECOND}) AS b
              FROM workout_log GROUP BY exercise) WHERE a IS NOT NULL AND b IS NOT NULL""",
    ),
)
def compare_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.compare_strength(log(spark, sf_dir), FIRST, SECOND)


@query("H25_athlete_cards", with_roles(ALL_ROLES, "SELECT * FROM cards", **CARDS))
def athlete_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return athletes.athlete_cards(
        log(spark, sf_dir), roles.body_metrics(spark, sf_dir), roles.nutrition_logs(spark, sf_dir)
    )
