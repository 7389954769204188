"""Queries over cleaning, source transforms and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import BRAND, SLUG, case_map, epley, rnd, with_roles
from tiersmith.functions import codes
from tiersmith.operators import cleaning, enrich, transforms
from tiersmith.plans import roles
from tiersmith.session import table

AT = "2024-02-01 00:00:00"


# ---- B: cleaning ----


@query("B1_B2_snake_case_columns", "SELECT event_id, user_id, user_id AS user_id_1, value AS http_value FROM events")
def snake_case_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("EventID"), F.col("user_id").alias("User Id"),
        F.col("user_id").alias("userID"), F.col("value").alias("HTTPValue"),
    )
    return cleaning.standardize_columns(raw)


@query("B3_trim_strings", "SELECT event_id, event_type, props FROM events")
def trim_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), "event_type", F.lit("  \n"))
    raw = table(spark, sf_dir, "events").select("event_id", padded.alias("event_type"), "props")
    return cleaning.trim_strings(raw)


@query(
    "B4_fill_nulls",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE value END AS value,
       CASE WHEN value > 100 THEN 'unknown' ELSE event_type END AS event_type FROM events""",
)
def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.when(F.col("value") <= 100, F.col("event_type")).alias("event_type"),
    )
    return cleaning.fill_nulls(gaps, 0, "unknown")


@query(
    "B5_coercing_cast",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS as_int,
       CASE WHEN event_type <> 'error' THEN value END AS as_float,
       CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS as_date,
       CAST(event_id AS VARCHAR) AS as_text, value > 100 AS as_flag FROM events""",
)
def coercing_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    def or_bad(c):
        return F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(c.cast("string"))

    raw = table(spark, sf_dir, "events").select(
        "event_id",
        or_bad(F.concat("user_id", F.lit(".0"))).alias("as_int"),
        or_bad(F.col("value")).alias("as_float"),
        or_bad(F.col("ts")).alias("as_date"),
        F.col("event_id").alias("as_text"),
        (F.col("value") > 100).cast("string").alias("as_flag"),
    )
    kinds = {
        "as_int": "integer", "as_float": "float", "as_date": "date", "as_text": "string",
        "as_flag": "boolean", "absent": "integer",
    }
    return cleaning.cast_types(raw, kinds)


def _dedup_sql(side: str) -> str:
    return f"""SELECT user_id, event_type, arg_{side}(event_id, event_id) AS event_id,
        arg_{side}(value, event_id) AS value FROM events GROUP BY user_id, event_type"""


def _dedup_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")


@query("B6_dedup_keep_last", _dedup_sql("max"))
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.deduplicate(_dedup_input(spark, sf_dir), ["user_id", "event_type"], "last", ["event_id"])


@query("B6_dedup_keep_first", _dedup_sql("min"))
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.deduplicate(_dedup_input(spark, sf_dir), ["user_id", "event_type"], "first", ["event_id"])


@query(
    "B6_dedup_keep_none",
    """SELECT l_orderkey, l_linenumber, ANY_VALUE(l_partkey) AS l_partkey FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) = 1""",
)
def dedup_keep_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return cleaning.deduplicate(lines, ["l_orderkey", "l_linenumber"], keep=False)


@query("B6_dedup_all_columns", "SELECT user_id, event_type, event_id, value FROM events")
def dedup_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _dedup_input(spark, sf_dir)
    twice = rows.withColumn("_batch", F.lit(1)).unionByName(rows.withColumn("_batch", F.lit(2)))
    return cleaning.deduplicate(twice).drop("_batch")


@query(
    "B7_clean_chain",
    """SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value,
       arg_max(CAST(ts AS DATE), event_id) AS event_day FROM events GROUP BY user_id, event_type""",
)
def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("UserID"),
        F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("Event Type"),
        F.col("event_id").cast("string").alias("EventID"),
        F.col("value").cast("string").alias("value"),
        F.col("ts").cast("string").alias("event-day"),
    )
    kinds = {"event_id": "integer", "value": "float", "event_day": "date"}
    return cleaning.clean(raw, kinds, ["user_id", "event_type"], ["event_id"])


# ---- C: source transforms ----


def raw_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an exercise API would deliver them: code arrays and a category code."""
    brand = roles.brand_code()
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit(" "), F.initcap("p_name"), F.lit("! ")).alias("name"),
        F.concat_ws(" ", "p_type", "p_brand").alias("description"),
        F.when(F.col("p_size") > 3, F.array(brand, F.col("p_size"), brand + 1))
        .when(F.col("p_size") > 1, F.array(brand))
        .otherwise(F.array().cast("array<int>"))
        .alias("muscles"),
        F.array("p_size").alias("equipment"),
        F.col("p_size").alias("category"),
        F.lit("en").alias("language"),
        F.lit("batch-1").alias("_batch_id"),
    )


def _library(spark: SparkSession, sf_dir: str, *cols) -> DataFrame:
    return transforms.transform(raw_exercises(spark, sf_dir), "exercise_api", "exercises").select("source_id", *cols)


MUSCLE = f"CASE WHEN p_size > 1 THEN {case_map(BRAND, codes.MUSCLES, 'full_body')} ELSE 'full_body' END"
SECONDARY = f"""CASE WHEN p_size > 3 THEN {case_map("p_size", codes.MUSCLES, "unknown")} || ',' ||
    {case_map(f"({BRAND} + 1)", codes.MUSCLES, "unknown")} ELSE '' END"""


@query(
    "C1_first_code_label",
    f"""SELECT p_partkey AS source_id, {MUSCLE} AS primary_muscle,
        {case_map("p_size", codes.EQUIPMENT, "none")} AS equipment FROM part""",
)
def first_code_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _library(spark, sf_dir, "primary_muscle", "equipment")


@query("C2_tail_code_labels", f"SELECT p_partkey AS source_id, {SECONDARY} AS secondary_muscles FROM part")
def tail_code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _library(spark, sf_dir, F.array_join("secondary_muscles", ",").alias("secondary_muscles"))


@query("C3_slug", f"SELECT p_partkey AS source_id, {SLUG.format(x='p_name')} AS slug FROM part")
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _library(spark, sf_dir, "slug")


@query(
    "C4_category_map",
    f"SELECT p_partkey AS source_id, {case_map('p_size', codes.EXERCISE_TYPES, 'compound')} AS exercise_type FROM part",
)
def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _library(spark, sf_dir, "exercise_type")


@query(
    "C5_defaults_and_keep_list",
    """SELECT p_partkey AS source_id, p_type || ' ' || p_brand AS instructions, 'intermediate' AS difficulty,
       FALSE AS is_unilateral, FALSE AS is_custom, 'batch-1' AS _batch_id FROM part""",
)
def defaults_and_keep_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = ["instructions", "difficulty", "is_unilateral", "is_custom", "_batch_id"]
    return _library(spark, sf_dir, *kept)


@query("C6_reference_rename", "SELECT c_custkey AS id, c_name AS name FROM customer")
def reference_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name_en"))
    return transforms.transform(raw, "exercise_api", "muscles")


@query(
    "C7_nutrient_pivot",
    """SELECT event_id AS usda_fdc_id, event_type AS food_name,
       CASE WHEN event_type <> 'error' THEN value * 2 END AS protein_g,
       CASE WHEN event_type <> 'error' THEN CAST(user_id AS DOUBLE) END AS calories,
       CAST(NULL AS DOUBLE) AS fats_g FROM events""",
)
def nutrient_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entry(code: int, value):
        return F.struct(F.lit(code).alias("nutrientId"), value.cast("double").alias("value"))

    entries = F.array(
        entry(1003, F.col("value")), entry(1008, F.col("user_id")), entry(1, F.lit(1)),
        entry(1003, F.col("value") * 2),
    )
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("fdc_id"),
        F.col("event_type").alias("description"),
        F.when(F.col("event_type") != "error", entries).alias("food_nutrients"),
    )
    foods = transforms.transform(raw, "food_api", "foods_search")
    return foods.select("usda_fdc_id", "food_name", "protein_g", "calories", "fats_g")


@query(
    "C8_pounds_to_kilograms",
    f"""SELECT l_orderkey, l_linenumber, 'kg' AS weight_unit,
        {rnd("CASE WHEN l_linestatus = 'O' THEN l_extendedprice * CAST(0.453592 AS DOUBLE) ELSE l_extendedprice END", 4)}
        AS weight FROM lineitem""",
)
def pounds_to_kilograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("weight"),
        F.when(F.col("l_linestatus") == "O", "Lbs").otherwise("kg").alias("weight_unit"),
    )
    out = transforms.transform(raw, "file_drop", "workout_logs")
    return out.withColumn("weight", F.round(F.col("weight").cast("decimal(38,8)"), 4).cast("double"))


@query("C9_inches_to_centimetres", "SELECT p_partkey, p_size * CAST(2.54 AS DOUBLE) AS waist_cm FROM part")
def inches_to_centimetres(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("waist_in"))
    return transforms.transform(raw, "file_drop", "body_metrics")


@query(
    "C10_date_parsing",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS log_date,
       CAST(o_orderdate AS DATE) AS due_date FROM orders""",
)
def date_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_orderdate").cast("string")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "soon").otherwise(text).alias("log_date"),
        text.alias("due_date"),
    )
    return transforms.transform(raw, "file_drop", "nutrition_logs")


@query(
    "C11_numeric_coercion",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS calories,
       CAST(user_id AS DOUBLE) AS protein_g FROM events""",
)
def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "many").otherwise(F.col("value").cast("string")).alias("calories"),
        F.col("user_id").cast("string").alias("protein_g"),
    )
    return transforms.transform(raw, "file_drop", "nutrition_logs")


@query(
    "C13_column_map_and_defaults",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS athlete_id, CAST(ts AS DATE) AS workout_date,
       'completed' AS status FROM events""",
)
def column_map_and_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("athlete_email"), F.col("ts").cast("date").alias("date")
    )
    return transforms.map_columns(
        raw, {"date": "workout_date", "athlete_email": "athlete_id"}, {"status": "completed"}
    )


# ---- D: enrichment ----


@query("D1_common_fields", f"SELECT event_id AS id, TIMESTAMP '{AT}' AS _processed_at FROM events")
def common_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return enrich.add_common(rows, F.lit(AT).cast("timestamp"))


def _enriched_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    library = transforms.transform(raw_exercises(spark, sf_dir), "exercise_api", "exercises")
    return enrich.exercises(library)


@query(
    "D2_compound_score",
    "SELECT p_partkey AS source_id, CASE WHEN p_size > 3 THEN 3 ELSE 1 END AS compound_score FROM part",
)
def compound_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched_exercises(spark, sf_dir).select("source_id", "compound_score")


@query(
    "D3_movement_category",
    f"SELECT p_partkey AS source_id, {case_map('(' + MUSCLE + ')', codes.MOVEMENTS, 'other')} AS movement_category FROM part",
)
def movement_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched_exercises(spark, sf_dir).select("source_id", "movement_category")


@query(
    "D4_date_parts",
    with_roles(
        "workouts",
        """SELECT id, dayname(workout_date) AS day_of_week, CAST(week(workout_date) AS INTEGER) AS week_number,
           CAST(month(workout_date) AS INTEGER) AS month FROM workouts""",
    ),
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enrich.workouts(roles.workouts(spark, sf_dir).select("id", "workout_date"))
    return out.select("id", "day_of_week", "week_number", "month")


def _lifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.workout_sets(spark, sf_dir).withColumnRenamed("weight_kg", "weight")


@query(
    "D5_set_volume_and_e1rm",
    with_roles(
        "workout_sets",
        f"""SELECT workout_id, exercise_id, set_number, {rnd("weight_kg * reps", 1)} AS set_volume_kg,
            {epley("weight_kg", "reps")} AS estimated_1rm FROM workout_sets""",
    ),
)
def set_volume_and_e1rm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enrich.workouts(_lifts(spark, sf_dir).drop("rpe"))
    return out.select("workout_id", "exercise_id", "set_number", "set_volume_kg", "estimated_1rm")


@query(
    "D6_intensity_zone",
    with_roles(
        "workout_sets",
        """SELECT workout_id, exercise_id, set_number, CASE WHEN rpe <= 0 THEN NULL WHEN rpe <= 7 THEN 'warm_up'
           WHEN rpe <= 8 THEN 'working' WHEN rpe <= 9 THEN 'hard' WHEN rpe <= 10 THEN 'max_effort' END
           AS intensity_zone FROM workout_sets""",
    ),
)
def intensity_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enrich.workouts(roles.workout_sets(spark, sf_dir))
    return out.select("workout_id", "exercise_id", "set_number", "intensity_zone")


@query(
    "D7_volume_per_set",
    with_roles(
        "workouts workout_sets",
        f"""SELECT w.id, {rnd("total_volume_kg / NULLIF(n, 0)", 1)} AS volume_per_set FROM workouts w
            LEFT JOIN (SELECT workout_id, COUNT(*) FILTER (WHERE set_type <> 'warmup') AS n
                       FROM workout_sets GROUP BY workout_id) s ON s.workout_id = w.id""",
    ),
)
def volume_per_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = roles.workout_sets(spark, sf_dir).groupBy(F.col("workout_id").alias("id")).agg(
        F.count_if(F.col("set_type") != "warmup").alias("total_sets")
    )
    sessions = roles.workouts(spark, sf_dir).select("id", "total_volume_kg").join(counted, "id", "left")
    return enrich.workouts(sessions).select("id", "volume_per_set")


@query(
    "D8_duration_category",
    with_roles(
        "workouts",
        """SELECT id, CASE WHEN duration_minutes <= 0 THEN NULL WHEN duration_minutes <= 45 THEN 'short'
           WHEN duration_minutes <= 60 THEN 'standard' WHEN duration_minutes <= 75 THEN 'moderate'
           WHEN duration_minutes <= 90 THEN 'long' WHEN duration_minutes <= 300 THEN 'marathon' END
           AS duration_category FROM workouts""",
    ),
)
def duration_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.workouts(roles.workouts(spark, sf_dir).select("id", "duration_minutes")).select(
        "id", "duration_category"
    )


FAT = rnd("weight_kg * body_fat_pct / 100", 1)


@query(
    "D9_fat_and_lean_mass",
    with_roles(
        "body_metrics",
        f"""SELECT id, {FAT} AS fat_mass_kg, {rnd(f"weight_kg - {FAT}", 1)} AS lean_mass_calc_kg FROM body_metrics""",
    ),
)
def fat_and_lean_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enrich.body_composition(roles.body_metrics(spark, sf_dir))
    return out.select("id", "fat_mass_kg", "lean_mass_calc_kg")


@query(
    "D10_weight_change",
    with_roles(
        "body_metrics",
        f"""SELECT id, {rnd("weight_kg - lag(weight_kg) OVER (PARTITION BY athlete_id ORDER BY measured_at, id)", 2)}
            AS weight_change_kg FROM body_metrics""",
    ),
)
def weight_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = roles.body_metrics(spark, sf_dir).select("id", "athlete_id", "measured_at", "weight_kg")
    return enrich.weight_change(metrics).select("id", "weight_change_kg")


@query(
    "D11_recovery_index",
    with_roles(
        "body_metrics",
        f"""SELECT id, {rnd("CAST(sleep_quality + (10 - stress_level) + recovery_score AS DOUBLE) / 3", 1)}
            AS recovery_index FROM body_metrics""",
    ),
)
def recovery_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.recovery_index(roles.body_metrics(spark, sf_dir)).select("id", "recovery_index")


CALS = {m: rnd(f"{m}_g * {k}", 0) for m, k in (("protein", 4), ("carbs", 4), ("fats", 9))}


def _nutrition_sql(select: str) -> str:
    cals = ", ".join(f"{s} AS c_{m}" for m, s in CALS.items())
    return with_roles(
        "nutrition_logs", f"SELECT id, {select} FROM macros",
        macros=f"SELECT id, protein_g, carbs_g, fats_g, {cals} FROM nutrition_logs",
    )


def _nutrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.nutrition(roles.nutrition_logs(spark, sf_dir))


@query("D12_macro_calories", _nutrition_sql(", ".join(f"c_{m} AS calories_from_{m}" for m in CALS)))
def macro_calories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nutrition(spark, sf_dir).select("id", *[f"calories_from_{m}" for m in CALS])


@query(
    "D13_macro_percentages",
    _nutrition_sql(
        ", ".join(f"{rnd(f'c_{m} / NULLIF(c_protein + c_carbs + c_fats, 0) * 100', 1)} AS {m}_pct" for m in CALS)
    ),
)
def macro_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nutrition(spark, sf_dir).select("id", *[f"{m}_pct" for m in CALS])


@query("D14_total_macros", _nutrition_sql(f"{rnd('protein_g + carbs_g + fats_g', 1)} AS total_macros_g"))
def total_macros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nutrition(spark, sf_dir).select("id", "total_macros_g")
