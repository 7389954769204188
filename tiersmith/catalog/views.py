"""Queries over the SQL views, functions, procedures, constraints and policies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import avg, dsum, epley, in_list, rnd, tot, when, with_roles
from tiersmith.catalog.warehouse import scd_inputs
from tiersmith.functions.dates import minutes_between
from tiersmith.functions.numeric import e1rm
from tiersmith.functions.text import DOUBLED, KEPT_S, STEPS, STOP_WORDS
from tiersmith.operators import contracts, integrity, policies, records, scd, search, staging
from tiersmith.plans import athletes, health, roles, sql_surface, training
from tiersmith.session import table, written

AS_OF = "2024-02-01 00:00:00"
WORKING = "set_type = 'working'"
# Parameters of the reports.
ATHLETE = 1
PERIOD = ("1997-01-01", "1998-12-31")


def parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        roles.workout_sets(spark, sf_dir), roles.workouts(spark, sf_dir), roles.exercises(spark, sf_dir)
    )


def at(text: str = AS_OF):
    return F.lit(text).cast("timestamp")


@query(
    "G1_weekly_training_summary",
    with_roles(
        "workouts",
        f"""SELECT athlete_id, CAST(date_trunc('week', workout_date) AS DATE) AS week_start,
            COUNT(*) AS workouts_completed, {rnd(avg("duration_minutes"), 0)} AS avg_duration_min,
            {rnd(dsum("total_volume_kg"), 0)} AS total_weekly_volume_kg,
            {rnd(avg("total_volume_kg"), 0)} AS avg_volume_per_session, {rnd(avg("energy_level"), 1)} AS avg_energy,
            {rnd(avg("pump_rating"), 1)} AS avg_pump, {rnd(avg("sleep_hours_prior"), 1)} AS avg_sleep_hours,
            COUNT(*) FILTER (WHERE status = 'skipped') AS sessions_skipped
            FROM workouts GROUP BY athlete_id, date_trunc('week', workout_date)""",
    ),
)
def weekly_training_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.weekly_training_summary(roles.workouts(spark, sf_dir))


@query(
    "G2_exercise_progression",
    with_roles(
        "set_rows",
        f"""SELECT athlete_id, exercise_name, primary_muscle, workout_date, COUNT(*) AS total_sets,
            COUNT(*) FILTER (WHERE {WORKING}) AS working_sets, {rnd("MAX(weight_kg)", 1)} AS max_weight_kg,
            {rnd(avg(when(WORKING, "weight_kg")), 1)} AS avg_working_weight_kg,
            {rnd(avg(when(WORKING, "reps")), 1)} AS avg_reps, {rnd(avg(when(WORKING, "rpe")), 1)} AS avg_rpe,
            {rnd(dsum(when(WORKING, "weight_kg * reps")), 0)} AS exercise_volume_kg
            FROM set_rows GROUP BY athlete_id, exercise_name, primary_muscle, workout_date""",
    ),
)
def exercise_progression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.exercise_progression(*parts(spark, sf_dir))


DAILY_SQL = f"""SELECT athlete_id, log_date, {tot("calories")} AS total_calories,
    {rnd(dsum("protein_g"), 1)} AS total_protein_g, {rnd(dsum("carbs_g"), 1)} AS total_carbs_g,
    {rnd(dsum("fats_g"), 1)} AS total_fats_g, {rnd(dsum("fiber_g"), 1)} AS total_fiber_g,
    CAST(SUM(water_ml) AS BIGINT) AS total_water_ml, COUNT(*) AS meals_logged,
    {rnd(f"{tot('protein_g')} * 4 / NULLIF({tot('calories')}, 0) * 100", 1)} AS protein_pct,
    {rnd(f"{tot('carbs_g')} * 4 / NULLIF({tot('calories')}, 0) * 100", 1)} AS carbs_pct,
    {rnd(f"{tot('fats_g')} * 9 / NULLIF({tot('calories')}, 0) * 100", 1)} AS fats_pct
    FROM nutrition_logs GROUP BY athlete_id, log_date"""


@query("G3_daily_nutrition_totals", with_roles("nutrition_logs", DAILY_SQL))
def daily_nutrition_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.daily_nutrition_totals(roles.nutrition_logs(spark, sf_dir))


@query(
    "G4_body_composition_weekly",
    with_roles(
        "body_metrics",
        f"""SELECT athlete_id, measured_at, weight_kg, body_fat_pct,
            {rnd("weight_kg * body_fat_pct / 100", 1)} AS fat_mass_kg, waist_cm, left_arm_cm, right_arm_cm,
            {rnd("abs(coalesce(right_arm_cm, 0) - coalesce(left_arm_cm, 0))", 1)} AS arm_difference_cm,
            resting_heart_rate, recovery_score, steps FROM body_metrics WHERE waist_cm IS NOT NULL""",
    ),
)
def body_composition_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.body_composition_weekly(roles.body_metrics(spark, sf_dir))


@query(
    "G5_muscle_volume_distribution",
    with_roles(
        "set_rows",
        f"""SELECT athlete_id, CAST(date_trunc('week', workout_date) AS DATE) AS week_start, primary_muscle,
            COUNT(*) FILTER (WHERE {WORKING}) AS working_sets,
            {rnd(dsum(when(WORKING, "weight_kg * reps")), 0)} AS total_volume_kg,
            {rnd(avg(when(WORKING, "rpe")), 1)} AS avg_rpe FROM set_rows WHERE status = 'completed'
            GROUP BY athlete_id, date_trunc('week', workout_date), primary_muscle""",
    ),
)
def muscle_volume_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.muscle_volume_distribution(*parts(spark, sf_dir))


@query(
    "G6_calculate_e1rm",
    with_roles(
        "workout_sets",
        f"""SELECT workout_id, exercise_id, set_number,
            CASE WHEN reps = 1 THEN weight_kg ELSE {epley("weight_kg", "reps")} END AS estimated_1rm FROM workout_sets""",
    ),
)
def calculate_e1rm(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimate = e1rm("weight_kg", "reps", exact_single=True).alias("estimated_1rm")
    return roles.workout_sets(spark, sf_dir).select("workout_id", "exercise_id", "set_number", estimate)


@query(
    "G7_workout_detail",
    with_roles(
        "workouts workout_sets exercises",
        """SELECT w.id AS workout_id, CAST(to_json({'id': id, 'workout_date': CAST(workout_date AS VARCHAR),
             'status': status, 'duration_minutes': duration_minutes, 'total_volume_kg': total_volume_kg,
             'energy_level': energy_level, 'pump_rating': pump_rating}) AS VARCHAR) AS workout,
           CAST(x.exercises AS VARCHAR) AS exercises, '["' || tag || '"]' AS tags
           FROM workouts w LEFT JOIN docs x ON x.workout_id = w.id
           LEFT JOIN (SELECT o_orderkey, o_orderpriority AS tag FROM orders) t ON t.o_orderkey = w.id""",
        blocks="""SELECT workout_id, exercise_id, min(set_number) AS first_set, list({'set_number': set_number,
            'set_type': set_type, 'weight_kg': weight_kg, 'reps': reps, 'rpe': rpe, 'rest_seconds': rest_seconds}
            ORDER BY set_number, set_type, weight_kg, reps, rpe, rest_seconds) AS sets
            FROM workout_sets GROUP BY workout_id, exercise_id""",
        docs="""SELECT workout_id, to_json(list({'exercise_name': name, 'muscle_group': primary_muscle,
            'equipment': equipment, 'sets': sets} ORDER BY first_set, exercise_id)) AS exercises
            FROM blocks JOIN exercises ON exercises.id = blocks.exercise_id GROUP BY workout_id""",
    ),
)
def workout_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets, workouts, exercises = parts(spark, sf_dir)
    tags = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("workout_id"), F.col("o_orderpriority").alias("name")
    )
    return training.workout_detail(workouts, sets, exercises, tags)


def personal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by date: every day an athlete reached a new best on an exercise."""
    sets, workouts, _ = parts(spark, sf_dir)
    return records.new_records(written(records.candidate_sets(sets, workouts), "candidates"), ORDER)


ORDER = ["workout_date", "workout_id", "set_number", "weight_kg", "reps"]
CANDIDATES = f"""SELECT s.*, w.athlete_id, w.workout_date, {epley("weight_kg", "reps")} AS e
    FROM workout_sets s JOIN workouts w ON s.workout_id = w.id WHERE {WORKING} AND reps > 0"""
RANKED = """SELECT *, max(e) OVER (PARTITION BY athlete_id, exercise_id ORDER BY workout_date, workout_id, set_number,
    weight_kg, reps ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM candidates"""
PR_SQL = f"""SELECT athlete_id, exercise_id, workout_id, workout_date AS achieved_date, '1rm' AS record_type,
    e AS new_value, previous AS previous_value,
    CASE WHEN previous > 0 THEN {rnd("(e - previous) / previous * 100", 2)} ELSE 100 END AS improvement_pct,
    set_number, weight_kg, reps FROM ranked WHERE previous IS NULL OR e > previous"""


@query(
    "G8_training_stats",
    with_roles(
        "workouts body_metrics nutrition_logs workout_sets",
        f"""SELECT s.*, start_weight, current_weight, avg_body_fat, avg_recovery, avg_calories, avg_protein, avg_carbs,
            avg_fats, coalesce(prs_hit, 0) AS prs_hit, CAST(date_diff('day', DATE '{PERIOD[0]}', DATE '{PERIOD[1]}') AS INTEGER) AS period_days
            FROM sessions s LEFT JOIN body b USING (athlete_id) LEFT JOIN food f USING (athlete_id)
            LEFT JOIN hits h USING (athlete_id)""",
        candidates=CANDIDATES,
        ranked=RANKED,
        prs=PR_SQL,
        sessions=f"""SELECT athlete_id, COUNT(*) AS total_sessions,
            COUNT(*) FILTER (WHERE status = 'completed') AS completed, COUNT(*) FILTER (WHERE status = 'skipped') AS skipped,
            {rnd("100 * (CAST(COUNT(*) FILTER (WHERE status = 'completed') AS DOUBLE) / COUNT(*))", 1)} AS completion_rate,
            {rnd(dsum("duration_minutes") + " / 60", 1)} AS total_hours, {rnd(avg("duration_minutes"), 0)} AS avg_duration_min,
            {rnd(dsum("total_volume_kg"), 0)} AS total_volume_kg, {rnd(avg("energy_level"), 1)} AS avg_energy
            FROM workouts WHERE workout_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY athlete_id""",
        shifted="""SELECT athlete_id, id, weight_kg, body_fat_pct, recovery_score,
            CAST(measured_at - INTERVAL 9862 DAY AS DATE) AS day, measured_at FROM body_metrics""",
        body=f"""SELECT athlete_id,
            arg_min(weight_kg, (measured_at, id)) FILTER (WHERE day >= DATE '{PERIOD[0]}') AS start_weight,
            arg_max(weight_kg, (measured_at, id)) FILTER (WHERE day <= DATE '{PERIOD[1]}') AS current_weight,
            {rnd(avg(f"CASE WHEN day BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' THEN body_fat_pct END"), 1)} AS avg_body_fat,
            {rnd(avg(f"CASE WHEN day BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' THEN recovery_score END"), 0)} AS avg_recovery
            FROM shifted GROUP BY athlete_id""",
        dated="SELECT * REPLACE (CAST(log_date - INTERVAL 9862 DAY AS DATE) AS log_date) FROM nutrition_logs",
        daily=DAILY_SQL.replace("FROM nutrition_logs", "FROM dated"),

        food=f"""SELECT athlete_id, {rnd(avg("total_calories"), 0)} AS avg_calories, {rnd(avg("total_protein_g"), 0)} AS avg_protein,
            {rnd(avg("total_carbs_g"), 0)} AS avg_carbs, {rnd(avg("total_fats_g"), 0)} AS avg_fats FROM daily
            WHERE log_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY athlete_id""",
        hits=f"""SELECT athlete_id, COUNT(*) AS prs_hit FROM prs
            WHERE achieved_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY athlete_id""",
    ),
)
def training_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements are from 2024, workouts from the nineties: the former move back 9862 days."""
    back = 9862
    shift = F.expr(f"INTERVAL '{back}' DAY")
    metrics = roles.body_metrics(spark, sf_dir).withColumn("measured_at", F.col("measured_at") - shift)
    logs = roles.nutrition_logs(spark, sf_dir).withColumn("log_date", F.date_sub("log_date", back))
    return athletes.training_stats(
        roles.workouts(spark, sf_dir), metrics, logs, personal_records(spark, sf_dir), *PERIOD,
        order=["measured_at", "id"],
    )


E1RM_EXACT = f"CASE WHEN reps = 1 THEN weight_kg ELSE {epley('weight_kg', 'reps')} END"


def _history_sql(where: str) -> str:
    return with_roles(
        "set_rows",
        f"""SELECT athlete_id, slug, workout_id, workout_date, weight_kg AS best_weight_kg, reps AS best_reps,
            {E1RM_EXACT} AS estimated_1rm FROM set_rows s WHERE {WORKING} {where} AND weight_kg = (SELECT MAX(weight_kg)
            FROM workout_sets x WHERE x.workout_id = s.workout_id AND x.exercise_id = s.exercise_id AND x.{WORKING})""",
    )


@query("G9_e1rm_history", _history_sql(""))
def e1rm_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.e1rm_history(*parts(spark, sf_dir))


@query("G9_e1rm_history_of_exercise", _history_sql("AND slug = 'hot-bolt'"))
def e1rm_history_of_exercise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.e1rm_history(*parts(spark, sf_dir), slug="hot-bolt")


def _stem_sql(words: str) -> str:
    """The stemming rules of ``functions.text`` in SQL."""
    for k, rules in enumerate(STEPS):
        arms = ""
        for ending, least, cut, put in rules:
            kept = "".join(f" AND NOT ends_with(x, '{e}')" for e in KEPT_S) if ending == "s" else ""
            arms += f" WHEN ends_with(x, '{ending}') AND length(x) >= {least}{kept} THEN left(x, length(x) - {cut}) || '{put}'"
        words = f"list_transform({words}, lambda x: CASE{arms} ELSE x END)"
        if k == 1:
            doubled = " OR ".join(f"ends_with(x, '{e}')" for e in DOUBLED)
            words = f"list_transform({words}, lambda x: CASE WHEN {doubled} THEN left(x, length(x) - 1) ELSE x END)"
    return words


def tokens_sql(text: str) -> str:
    """The words of ``functions.text.tokens`` in SQL."""
    words = f"""list_filter(string_split(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '),
        lambda x: x <> '' AND x NOT IN {in_list(STOP_WORDS)})"""
    return _stem_sql(words)


def _search_sql(source: str, key: str, text: str, terms: list[str]) -> str:
    has = " AND ".join(f"list_contains(w, '{t}')" for t in terms)
    return f"""WITH words AS (SELECT {key}, {tokens_sql(text)} AS w FROM {source}),
      hits AS (SELECT {key}, CAST(len(list_filter(w, lambda x: x IN {in_list(terms)})) AS INTEGER) AS hits,
        CAST(len(w) AS INTEGER) AS words FROM words WHERE {has})
      SELECT *, CAST(hits AS DOUBLE) / words AS score FROM hits"""


@query("G10_search_exercises", _search_sql("part", "p_partkey", "p_name || ' ' || p_type || ' ' || p_brand", ["hot", "bolt"]))
def search_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "part"), "The hot BOLT", ["p_name", "p_type", "p_brand"])
    return found.select("p_partkey", "hits", "words", "score")


@query("G10_search_documents", _search_sql("documents", "doc_id", "text", ["anat"]))
def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "documents"), "anat", ["text"])
    return found.select("doc_id", "hits", "words", "score")


@query(
    "G10_search_inverted_index",
    _search_sql("documents", "doc_id", "text", ["anat", "ing"]),
)
def search_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = search.inverted_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return search.search_index(index, "doc_id", "ing anat")


STORED_UNTIL = "1998-01-01"
STORED = f"""SELECT athlete_id, exercise_id, max(e) AS value FROM candidates
    WHERE workout_date < DATE '{STORED_UNTIL}' GROUP BY athlete_id, exercise_id"""
FLOORED = f"""SELECT c.*, greatest(max(e) OVER (PARTITION BY athlete_id, exercise_id ORDER BY workout_date, workout_id,
    set_number, weight_kg, reps ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), s.value) AS previous
    FROM (SELECT * FROM candidates WHERE workout_date >= DATE '{STORED_UNTIL}') c
    LEFT JOIN stored s USING (athlete_id, exercise_id)"""


def _stored_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records from the sets before a date, and the sets after it as the new batch."""
    sets, workouts, _ = parts(spark, sf_dir)
    candidates = written(records.candidate_sets(sets, workouts), "candidates")
    old = F.col("workout_date") < F.lit(STORED_UNTIL).cast("date")
    stored = candidates.filter(old).groupBy(*records.KEYS).agg(F.max("estimated_1rm").alias("value"))
    return stored, candidates.filter(~old)


# Every set counts for a log entry, and one repetition with its own weight.
LOGGED = f"""SELECT s.*, w.athlete_id, w.workout_date, CASE WHEN s.reps = 1 THEN s.weight_kg
    ELSE {epley("s.weight_kg", "s.reps")} END AS e FROM workout_sets s JOIN workouts w ON w.id = s.workout_id"""


@query(
    "G11_log_sets_with_pr_flag",
    with_roles(
        "workouts workout_sets exercises",
        """SELECT athlete_id, exercise_id, workout_id, set_number, set_type, weight_kg, reps, e AS estimated_1rm,
           previous AS previous_pr, previous IS NULL OR e > previous AS is_pr, CAST(NULL AS VARCHAR) AS error
           FROM floored WHERE exercise_id IN (SELECT id FROM exercises)
           UNION ALL SELECT athlete_id, exercise_id, workout_id, set_number, set_type, weight_kg, reps, e, NULL, NULL,
           'exercise not found' FROM candidates WHERE exercise_id NOT IN (SELECT id FROM exercises)""",
        candidates=LOGGED, stored=STORED, floored=FLOORED,
    ),
)
def log_sets_with_pr_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Joined once: the sets are read for the records, the ranges, their summary, the window and the errors.
    known, unknown = records.told_apart(written(records.matched_sets(*parts(spark, sf_dir)), "matched-sets"))
    old = F.col("workout_date") < F.lit(STORED_UNTIL).cast("date")
    stored = known.filter(old).groupBy(*records.KEYS).agg(F.max("estimated_1rm").alias("value"))
    flagged = records.flag_sets(known.filter(~old), ORDER, stored)
    listed = flagged.unionByName(unknown, allowMissingColumns=True)
    return listed.select(
        *records.KEYS, "workout_id", "set_number", "set_type", "weight_kg", "reps", "estimated_1rm", "previous_pr",
        "is_pr", "error",
    )


STAGED_SQL = """SELECT s_suppkey AS stg_id, CASE WHEN s_acctbal < 0 THEN '!!' WHEN s_nationkey < 12 THEN upper(n)
      ELSE s_name END AS name, CASE WHEN s_nationkey > 5 THEN 'text ' || s_suppkey END AS description
    FROM (SELECT *, (SELECT min(p_name) FROM part WHERE p_size = s_nationkey + 1) AS n FROM supplier)"""


def staged_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a staged batch: names of known exercises, new names, and names without a slug."""
    names = table(spark, sf_dir, "part").groupBy((F.col("p_size") - 1).alias("s_nationkey")).agg(
        F.min("p_name").alias("known")
    )
    suppliers = table(spark, sf_dir, "supplier").join(names, "s_nationkey", "left")
    name = (
        F.when(F.col("s_acctbal") < 0, "!!")
        .when(F.col("s_nationkey") < 12, F.upper("known"))
        .otherwise(F.col("s_name"))
    )
    text = F.when(F.col("s_nationkey") > 5, F.concat(F.lit("text "), F.col("s_suppkey")))
    return suppliers.select(F.col("s_suppkey").alias("stg_id"), name.alias("name"), text.alias("description"))


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exercise library with one row per slug."""
    e = roles.exercises(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    return e.groupBy("slug").agg(F.max_by(F.struct(*e.columns), F.col("id").cast("long")).alias("r")).select("r.*")


SLUGGED = f"""SELECT *, trim(regexp_replace(regexp_replace(lower(name), '[^a-z0-9\\s]', '', 'g'), '\\s+', '-', 'g'), '-') AS slug
    FROM staged"""
LATE = """SELECT slug, arg_max(name, stg_id) AS n, arg_max(description, stg_id) FILTER (WHERE description IS NOT NULL) AS t,
    COUNT(*) AS rows FROM slugged WHERE slug <> '' GROUP BY slug"""
LIB = "SELECT slug, arg_max(name, id) AS name, arg_max(instructions, id) AS instructions, arg_max(primary_muscle, id) AS primary_muscle FROM exercises GROUP BY slug"
MERGED = """SELECT slug, coalesce(n, name) AS name, coalesce(t, instructions) AS instructions,
    CASE WHEN lib.slug IS NULL THEN 'full_body' ELSE primary_muscle END AS primary_muscle,
    CASE WHEN lib.slug IS NULL THEN 'INSERT' WHEN late.slug IS NOT NULL THEN 'UPDATE' ELSE 'KEEP' END AS action,
    name AS old_name, instructions AS old_instructions, coalesce(rows, 0) AS staged_rows
    FROM lib FULL JOIN late USING (slug)"""


def _staging_sql(body: str) -> str:
    return with_roles("exercises", body, staged=STAGED_SQL, slugged=SLUGGED, late=LATE, lib=LIB, merged=MERGED)


def merged_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.merge_exercises(library(spark, sf_dir), staged_exercises(spark, sf_dir), ["stg_id"])


@query(
    "G12_process_staged_exercises",
    _staging_sql("SELECT slug, name, instructions, primary_muscle, action FROM merged"),
)
def process_staged_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merged_library(spark, sf_dir)
    return merged.select("slug", "name", "instructions", "primary_muscle", F.col("_action").alias("action"))


@query(
    "G12_merge_counts",
    _staging_sql(
        """SELECT COUNT(*) FILTER (WHERE action = 'INSERT') AS inserted,
           CAST(SUM(CASE action WHEN 'UPDATE' THEN staged_rows WHEN 'INSERT' THEN staged_rows - 1 END) AS BIGINT) AS updated,
           CAST(0 AS BIGINT) AS skipped, (SELECT COUNT(*) FROM slugged WHERE slug = '') AS failed FROM merged"""
    ),
)
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.merge_counts(merged_library(spark, sf_dir), staged_exercises(spark, sf_dir))


@query(
    "G13_weekly_volume",
    with_roles(
        "set_rows",
        f"""SELECT athlete_id, CAST(date_trunc('week', workout_date) AS DATE) AS week_start,
            COUNT(DISTINCT workout_id) AS total_workouts, COUNT(*) AS total_sets,
            {rnd(dsum("weight_kg * reps"), 2)} AS total_volume_kg, CAST(SUM(reps) AS BIGINT) AS total_reps,
            {rnd(avg("rpe"), 1)} AS avg_rpe, array_to_string(list_sort(list(DISTINCT primary_muscle)), ',') AS muscles_trained,
            CAST(COUNT(DISTINCT workout_date) AS INTEGER) AS training_days FROM set_rows
            WHERE status = 'completed' AND set_type <> 'warmup' GROUP BY athlete_id, date_trunc('week', workout_date)""",
    ),
)
def weekly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = training.weekly_volume(*parts(spark, sf_dir))
    return out.withColumn("muscles_trained", F.array_join("muscles_trained", ","))


@query(
    "G14_detect_new_prs",
    with_roles("workouts workout_sets", PR_SQL, candidates=CANDIDATES, ranked=RANKED),
)
def detect_new_prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_records(spark, sf_dir)


@query(
    "G14_upsert_records",
    with_roles(
        "workouts workout_sets",
        f"""SELECT athlete_id, exercise_id, coalesce(v, s.value) AS value FROM stored s FULL JOIN (
             SELECT athlete_id, exercise_id, max(e) AS v FROM floored WHERE previous IS NULL OR e > previous
             GROUP BY athlete_id, exercise_id) n USING (athlete_id, exercise_id)""",
        candidates=CANDIDATES, stored=STORED, floored=FLOORED,
    ),
)
def upsert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, batch = _stored_and_new(spark, sf_dir)
    found = records.new_records(batch, ORDER, stored)
    table_now = stored.withColumns(
        {"previous_value": F.lit(None).cast("double"), "achieved_date": F.lit(None).cast("date")}
    )
    return records.upsert_records(table_now, found).select(*records.KEYS, "value")


SUMMARY_TABLES = {
    "athletes": (None, "TIMESTAMP '2024-01-31'"), "exercises": (None, "TIMESTAMP '2024-01-31'"),
    "workouts": (("workout_date", 7), "workout_date"), "workout_sets": (None, "TIMESTAMP '2024-01-31'"),
    "body_metrics": (("measured_at", 3), "measured_at"), "nutrition_logs": (("log_date", 2), "log_date"),
}


def _health_sql() -> str:
    rows = []
    for t, (stale, updated) in SUMMARY_TABLES.items():
        missing = rnd("100 * CAST(COUNT(*) - COUNT(weight_kg) AS DOUBLE) / COUNT(*)", 2) if t == "body_metrics" else "0"
        status = "'healthy'"
        if stale:
            status = f"CASE WHEN MAX(CAST({stale[0]} AS DATE)) < DATE '2024-02-01' - {stale[1]} THEN 'stale' ELSE 'healthy' END"
        rows.append(
            f"""SELECT '{t}' AS table_name, COUNT(*) AS row_count, CAST({missing} AS DOUBLE) AS null_percentage,
            CAST(MAX({updated}) AS TIMESTAMP) AS last_updated, {status} AS status FROM {t}"""
        )
    return with_roles(" ".join(SUMMARY_TABLES), " UNION ALL ".join(rows))


@query("G15_health_summary", _health_sql())
def health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = {"_loaded_at": at("2024-01-31 00:00:00")}
    tables = {
        "athletes": roles.athletes(spark, sf_dir).withColumns(stamp),
        "exercises": roles.exercises(spark, sf_dir).withColumns(stamp),
        "workouts": roles.workouts(spark, sf_dir),
        "workout_sets": roles.workout_sets(spark, sf_dir).withColumns(stamp),
        "body_metrics": roles.body_metrics(spark, sf_dir),
        "nutrition_logs": roles.nutrition_logs(spark, sf_dir),
    }
    dates = {"workouts": "workout_date", "body_metrics": "measured_at", "nutrition_logs": "log_date"}
    return athletes.health_summary(tables, {t: dates.get(t, "_loaded_at") for t in tables}, at())


@query(
    "G16_update_session_totals",
    with_roles(
        "workouts workout_sets",
        f"""SELECT w.id, coalesce(v, w.total_volume_kg) AS total_volume_kg, n AS total_sets FROM workouts w LEFT JOIN (
              SELECT workout_id, {rnd(dsum("weight_kg * reps"), 2)} AS v, COUNT(*) FILTER (WHERE set_type <> 'warmup') AS n
              FROM workout_sets GROUP BY workout_id) s ON s.workout_id = w.id""",
    ),
)
def update_session_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = training.update_session_totals(roles.workouts(spark, sf_dir), roles.workout_sets(spark, sf_dir))
    return out.select("id", "total_volume_kg", "total_sets")


SUPPLEMENTS = [("Creatine", "5g", "morning"), ("Vitamin D3", "5000 IU", "morning"), ("Zinc", "30mg", "evening")]


@query(
    "G17_date_spine_by_list",
    """SELECT CAST(d AS DATE) AS log_date, s.name, s.dosage, s.timing
       FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders),
         (VALUES ('Creatine','5g','morning'),('Vitamin D3','5000 IU','morning'),('Zinc','30mg','evening')) s(name, dosage, timing)
       WHERE dayofweek(d) IN (1, 3, 5)""",
)
def date_spine_by_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every Monday, Wednesday and Friday of the order period with every list entry."""
    bounds = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")
    )
    entries = F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(d).alias("dosage"), F.lit(t).alias("timing"))
        for n, d, t in SUPPLEMENTS
    ])
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("log_date"))
    return (
        days.filter(F.weekday("log_date").isin(0, 2, 4))
        .select("log_date", F.explode(entries).alias("e"))
        .select("log_date", "e.*")
    )


@query(
    "G18_generated_duration",
    "SELECT user_id, CAST(round((epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts)))) / 60) AS INTEGER) AS duration_minutes FROM events GROUP BY user_id",
)
def generated_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min("ts").cast("timestamp").alias("start_time"), F.max("ts").cast("timestamp").alias("end_time")
    )
    return spans.select("user_id", minutes_between(F.col("start_time"), F.col("end_time")).alias("duration_minutes"))


SET_CHECKS = [
    contracts.Field("set_type", required=True, allowed=("warmup", "working", "drop", "failure")),
    contracts.Field("weight_kg", ge=0, le=100000, kind="number"),
    contracts.Field("reps", ge=0, le=45, kind="number"),
    contracts.Field("rpe", ge=3, le=10, kind="number"),
]


@query(
    "G19_check_constraints",
    with_roles(
        "workout_sets",
        """SELECT field, message, COUNT(*) AS n FROM (
             SELECT 'weight_kg' AS field, 'Greater than 100000' AS message FROM workout_sets WHERE weight_kg > 100000
             UNION ALL SELECT 'reps', 'Greater than 45' FROM workout_sets WHERE reps > 45
             UNION ALL SELECT 'rpe', 'Less than 3' FROM workout_sets WHERE rpe < 3) GROUP BY field, message""",
    ),
)
def check_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = contracts.with_violations(roles.workout_sets(spark, sf_dir), SET_CHECKS)
    broken = checked.select(F.explode("_violations").alias("v")).select("v.field", "v.message")
    return broken.groupBy("field", "message").agg(F.count("*").alias("n"))


@query(
    "G20_key_uniqueness",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1",
)
def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "G21_referential_checks",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def referential_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders checked against suppliers instead of customers: most references have no target."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return integrity.orphans(orders, "o_custkey", table(spark, sf_dir, "supplier"), "s_suppkey")


GONE = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


@query(
    "G22_cascade_delete",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN ({GONE})",
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return integrity.cascade_delete(orders, "o_custkey", gone, "c_custkey")


@query(
    "G22_set_null_delete",
    f"SELECT o_orderkey, CASE WHEN o_custkey NOT IN ({GONE}) THEN o_custkey END AS o_custkey FROM orders",
)
def set_null_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return integrity.set_null_delete(orders, "o_custkey", gone, "c_custkey")


@query(
    "G23_audit_trail",
    _staging_sql(
        f"""SELECT action AS event_type, 'exercises' AS target_table, slug AS target_record_id,
            TIMESTAMP '{AS_OF}' AS event_timestamp, 'batch-1' AS batch_id, 'exercise_api' AS source_name,
            CASE WHEN action = 'UPDATE' THEN CAST(to_json({{'name': old_name, 'instructions': old_instructions}}) AS VARCHAR) END AS old_values,
            CAST(to_json({{'name': name, 'instructions': instructions}}) AS VARCHAR) AS new_values,
            CASE action WHEN 'INSERT' THEN 'New row from staging' ELSE 'Staged row update' END AS change_reason,
            'etl' AS triggered_by FROM merged WHERE action <> 'KEEP'"""
    ),
)
def audit_trail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.merge_audit(merged_library(spark, sf_dir), "batch-1", at())


@query(
    "G23_scd_audit",
    """WITH changed AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_nationkey <> 3)
       SELECT 'SCD_CLOSE' AS event_type, CAST(c_custkey AS VARCHAR) AS target_record_id FROM changed
       UNION ALL SELECT 'SCD_INSERT', CAST(c_custkey AS VARCHAR) FROM changed
       UNION ALL SELECT 'SCD_INSERT', CAST(-1 - s_suppkey AS VARCHAR) FROM supplier""",
)
def scd_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, incoming = scd_inputs(spark, sf_dir)
    cols = ["c_name", "c_mktsegment"]
    merged = scd.merge(existing, incoming, ["c_custkey"], cols, at())
    audit = staging.scd_audit(merged, "customer", "c_custkey", at(), cols, "batch-1")
    return audit.select("event_type", "target_record_id")


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "workouts": roles.workouts(spark, sf_dir), "workout_sets": roles.workout_sets(spark, sf_dir),
        "exercises": roles.exercises(spark, sf_dir), "body_metrics": roles.body_metrics(spark, sf_dir),
    }


@query("G24_own_rows", with_roles("workouts", f"SELECT id, workout_date, status FROM workouts WHERE athlete_id = {ATHLETE}"))
def own_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.visible(_tables(spark, sf_dir), "workouts", ATHLETE).select("id", "workout_date", "status")


@query(
    "G25_rows_through_parent",
    with_roles(
        "workouts workout_sets",
        f"SELECT * FROM workout_sets WHERE workout_id IN (SELECT id FROM workouts WHERE athlete_id = {ATHLETE})",
    ),
)
def rows_through_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policies.visible(_tables(spark, sf_dir), "workout_sets", ATHLETE)


@query(
    "G26_write_check",
    f"""SELECT o_orderkey, o_custkey, coalesce(o_orderstatus = 'O' AND o_custkey = {ATHLETE}, FALSE) AS accepted FROM orders""",
)
def write_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderstatus") == "O").alias("is_custom"))
    allowed = F.col("is_custom") & (F.col("o_custkey") == ATHLETE)
    return policies.check_writes(rows, allowed).select("o_orderkey", "o_custkey", F.col("_accepted").alias("accepted"))


@query(
    "G27_public_and_service_role",
    with_roles(
        "exercises body_metrics",
        """SELECT 'exercises' AS table_name, id FROM exercises UNION ALL SELECT 'body_metrics', id FROM body_metrics""",
    ),
)
def public_and_service_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    public = policies.visible(tables, "exercises", ATHLETE)
    bypass = policies.visible(tables, "body_metrics", ATHLETE, service_role=True)
    named = [d.select(F.lit(n).alias("table_name"), "id") for n, d in (("exercises", public), ("body_metrics", bypass))]
    return reduce(DataFrame.unionByName, named)


@query(
    "G28_metrics_summary",
    with_roles(
        "body_metrics",
        f"""SELECT COUNT(*) AS days_tracked, {rnd(avg("weight_kg"), 1)} AS avg_weight, {rnd("MIN(weight_kg)", 1)} AS min_weight,
            {rnd("MAX(weight_kg)", 1)} AS max_weight, {rnd(avg("body_fat_pct"), 1)} AS avg_body_fat FROM body_metrics""",
    ),
)
def metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.metrics_summary(roles.body_metrics(spark, sf_dir))


@query(
    "G28_meal_summary",
    with_roles(
        "nutrition_logs",
        f"""SELECT meal_type, COUNT(*) AS meals, {rnd(avg("calories"), 0)} AS avg_calories,
            {rnd(avg("protein_g"), 0)} AS avg_protein_g FROM nutrition_logs GROUP BY meal_type""",
    ),
)
def meal_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.meal_summary(roles.nutrition_logs(spark, sf_dir)).orderBy(F.desc("avg_calories"))


# ---- the same through SQL ----


def _sql_tables(spark: SparkSession, sf_dir: str) -> None:
    tables = _tables(spark, sf_dir) | {"nutrition_logs": roles.nutrition_logs(spark, sf_dir)}
    sql_surface.register(spark, tables)


@query(
    "K_sql_scalar_function",
    with_roles(
        "workout_sets",
        f"SELECT exercise_id, MAX({E1RM_EXACT}) AS best_e1rm FROM workout_sets GROUP BY exercise_id",
    ),
)
def sql_scalar_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    _sql_tables(spark, sf_dir)
    return spark.sql(
        "SELECT exercise_id, max(calculate_e1rm(weight_kg, reps)) AS best_e1rm FROM workout_sets GROUP BY exercise_id"
    )


@query(
    "K_sql_view",
    with_roles(
        "body_metrics",
        f"""SELECT athlete_id, COUNT(*) AS measurements, MAX({rnd("abs(coalesce(right_arm_cm, 0) - coalesce(left_arm_cm, 0))", 1)})
            AS widest FROM body_metrics WHERE waist_cm IS NOT NULL GROUP BY athlete_id""",
    ),
)
def sql_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    _sql_tables(spark, sf_dir)
    return spark.sql(
        """SELECT athlete_id, count(*) AS measurements, max(arm_difference_cm) AS widest
           FROM body_composition_weekly GROUP BY athlete_id"""
    )


@query(
    "K_sql_table_function",
    with_roles(
        "set_rows",
        f"""SELECT CAST(date_trunc('week', workout_date) AS DATE) AS week_start, COUNT(*) AS total_sets,
            {rnd(dsum("weight_kg * reps"), 2)} AS total_volume_kg FROM set_rows
            WHERE status = 'completed' AND set_type <> 'warmup' AND athlete_id = {ATHLETE}
            GROUP BY date_trunc('week', workout_date)""",
    ),
)
def sql_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    _sql_tables(spark, sf_dir)
    return spark.sql(f"SELECT week_start, total_sets, total_volume_kg FROM calculate_weekly_volume({ATHLETE})")


@query(
    "K_sql_new_records_of_workout",
    with_roles(
        "workouts workout_sets",
        f"SELECT exercise_id, new_value, previous_value FROM ({PR_SQL}) WHERE athlete_id = {ATHLETE} AND workout_id = (SELECT min(id) FROM workouts WHERE athlete_id = {ATHLETE})",
        candidates=CANDIDATES, ranked=RANKED,
    ),
)
def sql_new_records_of_workout(spark: SparkSession, sf_dir: str) -> DataFrame:
    _sql_tables(spark, sf_dir)
    return spark.sql(
        f"""SELECT exercise_id, new_value, previous_value FROM new_records
            WHERE athlete_id = {ATHLETE} AND workout_id = (SELECT min(id) FROM workouts WHERE athlete_id = {ATHLETE})"""
    )
