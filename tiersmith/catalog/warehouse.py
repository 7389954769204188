"""Queries over dimensions, facts and type 2 history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import dsum, rnd, with_roles
from tiersmith.functions.numeric import rounded, total
from tiersmith.operators import dimensions, enrich, scd
from tiersmith.plans import roles
from tiersmith.session import table

AS_OF = "2024-02-01 00:00:00"
FIRST = "2023-01-01 00:00:00"


def at(text: str):
    return F.lit(text).cast("timestamp")


DIM_DATE_SQL = """SELECT strftime(d, '%Y-%m-%d') AS date_key, CAST(d AS DATE) AS full_date,
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
    monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
    CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) < 6 AS is_weekday,
    isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start, last_day(d) = CAST(d AS DATE) AS is_month_end,
    CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)"""


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.date_dimension(dimensions.date_bounds(table(spark, sf_dir, "orders"), "o_orderdate"))


query("E1_dim_date", DIM_DATE_SQL)(dim_date)


@query(
    "E2_dim_muscle_groups",
    with_roles(
        "exercises",
        """SELECT g.name, g.body_region, g.is_compound_target, md5(g.name) AS id, COUNT(e.id) AS exercises
           FROM (VALUES ('chest','upper_body',TRUE),('back','upper_body',TRUE),('shoulders','upper_body',TRUE),
             ('biceps','upper_body',FALSE),('triceps','upper_body',FALSE),('forearms','upper_body',FALSE),
             ('quads','lower_body',TRUE),('hamstrings','lower_body',TRUE),('glutes','lower_body',TRUE),
             ('calves','lower_body',FALSE),('abs','core',FALSE),('obliques','core',FALSE),
             ('traps','upper_body',FALSE),('lats','upper_body',TRUE),('hip_flexors','lower_body',FALSE),
             ('adductors','lower_body',FALSE),('abductors','lower_body',FALSE),('neck','upper_body',FALSE),
             ('full_body','full_body',TRUE)) g(name, body_region, is_compound_target)
           LEFT JOIN exercises e ON e.primary_muscle = g.name GROUP BY ALL""",
    ),
)
def dim_muscle_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension with the number of exercises per group, so that it is checked against its use."""
    used = roles.exercises(spark, sf_dir).groupBy(F.col("primary_muscle").alias("name")).agg(
        F.count("*").alias("exercises")
    )
    return dimensions.muscle_groups(spark).join(used, "name", "left").fillna(0, ["exercises"])


@query(
    "E3_dim_athletes",
    with_roles(
        "athletes",
        f"""SELECT *, TIMESTAMP '{AS_OF}' AS effective_from, TIMESTAMP '9999-12-31' AS effective_to,
            TRUE AS is_current FROM athletes""",
    ),
)
def dim_athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.athletes(roles.athletes(spark, sf_dir), at(AS_OF))


@query(
    "E4_dim_exercises",
    with_roles(
        "exercises",
        f"""SELECT name, slug, primary_muscle, '' AS secondary_muscles, exercise_type, equipment, difficulty,
            instructions, FALSE AS is_unilateral, FALSE AS is_custom, md5(CAST(id AS VARCHAR)) AS id,
            TIMESTAMP '{AS_OF}' AS effective_from, TIMESTAMP '9999-12-31' AS effective_to, TRUE AS is_current,
            1 AS compound_score FROM exercises""",
    ),
)
def dim_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = roles.exercises(spark, sf_dir).withColumnRenamed("id", "source_id")
    dim = dimensions.exercises(silver.withColumn("compound_score", F.lit(1)), at(AS_OF), key=["source_id"])
    return dim.withColumn("secondary_muscles", F.coalesce(F.array_join("secondary_muscles", ","), F.lit("")))


@query(
    "E5_fact_workouts",
    with_roles(
        "workouts",
        """SELECT id, athlete_id, strftime(workout_date, '%Y-%m-%d') AS date_key, workout_date, status,
           CAST(duration_minutes AS DOUBLE) AS duration_minutes, total_volume_kg,
           CAST(energy_level AS DOUBLE) AS energy_level, CAST(pump_rating AS DOUBLE) AS pump_rating,
           sleep_hours_prior, dayname(workout_date) AS day_of_week,
           CAST(week(workout_date) AS INTEGER) AS week_number,
           CASE WHEN duration_minutes <= 45 THEN 'short' WHEN duration_minutes <= 60 THEN 'standard'
             WHEN duration_minutes <= 75 THEN 'moderate' WHEN duration_minutes <= 90 THEN 'long'
             WHEN duration_minutes <= 300 THEN 'marathon' END AS duration_category FROM workouts""",
    ),
)
def fact_workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.fact_workouts(enrich.workouts(roles.workouts(spark, sf_dir)))


@query(
    "E6_fact_body_metrics",
    with_roles(
        "body_metrics",
        f"""SELECT id, athlete_id, strftime(measured_at, '%Y-%m-%d') AS date_key, measured_at, weight_kg,
            body_fat_pct, CAST(waist_cm AS DOUBLE) AS waist_cm,
            CAST(resting_heart_rate AS DOUBLE) AS resting_heart_rate, CAST(sleep_quality AS DOUBLE) AS sleep_quality,
            CAST(stress_level AS DOUBLE) AS stress_level, CAST(recovery_score AS DOUBLE) AS recovery_score,
            CAST(steps AS DOUBLE) AS steps, {rnd("weight_kg * body_fat_pct / 100", 1)} AS fat_mass_kg,
            {rnd(f"weight_kg - {rnd('weight_kg * body_fat_pct / 100', 1)}", 1)} AS lean_mass_calc_kg
            FROM body_metrics""",
    ),
)
def fact_body_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.fact_body_metrics(enrich.body_composition(roles.body_metrics(spark, sf_dir)))


@query(
    "E7_fact_nutrition",
    with_roles(
        "nutrition_logs",
        f"""SELECT id, athlete_id, strftime(log_date, '%Y-%m-%d') AS date_key, log_date, meal_type, calories,
            protein_g, carbs_g, fats_g, fiber_g, CAST(water_ml AS DOUBLE) AS water_ml,
            {rnd("protein_g + carbs_g + fats_g", 1)} AS total_macros_g FROM nutrition_logs""",
    ),
)
def fact_nutrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = dimensions.fact_nutrition(enrich.nutrition(roles.nutrition_logs(spark, sf_dir)))
    shares = [c for c in fact.columns if c.endswith("_pct") or c.startswith("calories_from")]
    return fact.drop(*shares)


@query(
    "E8_scd2_first_load",
    with_roles(
        "athletes",
        f"""SELECT id, activity_level, TIMESTAMP '{FIRST}' AS effective_from, TIMESTAMP '9999-12-31' AS effective_to,
            TRUE AS is_current FROM athletes""",
    ),
)
def scd2_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.first_load(roles.athletes(spark, sf_dir).select("id", "activity_level"), at(FIRST))


SCD_SQL = f"""WITH existing AS (
    SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '{FIRST}' AS effective_from,
      TIMESTAMP '9999-12-31' AS effective_to, TRUE AS is_current FROM customer
    UNION ALL SELECT c_custkey, c_name, 'OLD', TIMESTAMP '2022-01-01', TIMESTAMP '{FIRST}', FALSE
      FROM customer WHERE c_acctbal > 9000),
  incoming AS (
    SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
      FROM customer WHERE c_nationkey <> 3
    UNION ALL SELECT -1 - s_suppkey, s_name, 'SUPPLIER' FROM supplier),
  changed AS (SELECT e.c_custkey FROM existing e JOIN incoming i USING (c_custkey)
    WHERE e.is_current AND (e.c_mktsegment IS DISTINCT FROM i.c_mktsegment OR e.c_name IS DISTINCT FROM i.c_name))
  SELECT c_custkey, c_name, c_mktsegment, effective_from,
    CASE WHEN is_current AND c_custkey IN (FROM changed) THEN TIMESTAMP '{AS_OF}' ELSE effective_to END AS effective_to,
    is_current AND c_custkey NOT IN (FROM changed) AS is_current FROM existing
  UNION ALL SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '{AS_OF}', TIMESTAMP '9999-12-31', TRUE FROM incoming
    WHERE c_custkey IN (FROM changed) OR c_custkey NOT IN (SELECT c_custkey FROM existing)"""


def scd_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A history of all customers, and a load with changed, unchanged, absent and new keys."""
    customers = table(spark, sf_dir, "customer")
    cols = ["c_custkey", "c_name", "c_mktsegment"]
    past = customers.filter(F.col("c_acctbal") > 9000).select(
        "c_custkey", "c_name", F.lit("OLD").alias("c_mktsegment"),
        at("2022-01-01 00:00:00").alias("effective_from"), at(FIRST).alias("effective_to"),
        F.lit(False).alias("is_current"),
    )
    existing = scd.first_load(customers.select(*cols), at(FIRST)).unionByName(past)
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("c_mktsegment")
    suppliers = table(spark, sf_dir, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    incoming = customers.filter(F.col("c_nationkey") != 3).select("c_custkey", "c_name", segment)
    return existing, incoming.unionByName(suppliers)


@query("E9_scd2_merge", SCD_SQL)
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, incoming = scd_inputs(spark, sf_dir)
    return scd.merge(existing, incoming, ["c_custkey"], ["c_name", "c_mktsegment"], at(AS_OF))


@query(
    "E10_star_join",
    with_roles(
        "workouts athletes",
        f"""SELECT d.year, d.quarter, a.activity_level, COUNT(*) AS workouts,
            {rnd(dsum("w.total_volume_kg"), 0)} AS volume_kg
            FROM workouts w JOIN dim_date d ON strftime(w.workout_date, '%Y-%m-%d') = d.date_key
            JOIN athletes a ON a.id = w.athlete_id WHERE d.is_weekday
            GROUP BY d.year, d.quarter, a.activity_level""",
        dim_date=DIM_DATE_SQL,
    ),
)
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = dimensions.fact_workouts(roles.workouts(spark, sf_dir)).select("date_key", "athlete_id", "total_volume_kg")
    days = dim_date(spark, sf_dir).filter("is_weekday").select("date_key", "year", "quarter")
    people = roles.athletes(spark, sf_dir).select(F.col("id").alias("athlete_id"), "activity_level")
    # The dimension is one row per calendar day, so its size does not grow with the facts.
    return (
        fact.join(F.broadcast(days), "date_key")
        .join(people, "athlete_id")
        .groupBy("year", "quarter", "activity_level")
        .agg(
            F.count("*").alias("workouts"),
            rounded(total("total_volume_kg"), 0).alias("volume_kg"),
        )
    )
