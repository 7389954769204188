"""Text blocks for the checking SQL: roundings, means, and the roles as common table expressions."""

from __future__ import annotations

from tiersmith.functions import codes


def rnd(x: str, digits: int = 0) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


# Six decimals: a value beyond the type is an error here, so nothing is lost unnoticed.
def dsum(x: str) -> str:
    return f"SUM(CAST({x} AS DECIMAL(28,6)))"


def tot(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


def avg(x: str) -> str:
    return f"(CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def when(condition: str, x: str) -> str:
    return f"CASE WHEN {condition} THEN {x} END"


def case_map(expr: str, mapping: dict, default: str | None) -> str:
    arms = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    tail = f" ELSE {default!r}" if default is not None else ""
    return f"(CASE {expr} {arms}{tail} END)"


def in_list(values) -> str:
    return "(" + ", ".join(repr(v) for v in values) + ")"


SLUG = (
    "trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9\\s]', '', 'g'), '\\s+', '-', 'g'), '-')"
)
BRAND = "CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER)"

ROLES = {
    "athletes": """SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS activity_level,
        c_acctbal AS target_weight_kg FROM customer""",
    "workouts": """SELECT o_orderkey AS id, o_custkey AS athlete_id, CAST(o_orderdate AS DATE) AS workout_date,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'skipped' WHEN 'P' THEN 'partial'
            ELSE 'planned' END AS status,
        CAST(floor(o_totalprice / 2500) AS INTEGER) + 10 AS duration_minutes,
        o_totalprice AS total_volume_kg,
        CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 2 AS energy_level,
        11 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 2 AS pump_rating,
        CAST(4.5 AS DOUBLE) + CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) * CAST(0.5 AS DOUBLE)
            AS sleep_hours_prior FROM orders""",
    "workout_sets": """SELECT l_orderkey AS workout_id, l_partkey AS exercise_id, l_linenumber AS set_number,
        CASE WHEN l_returnflag = 'R' THEN 'warmup' ELSE 'working' END AS set_type,
        l_extendedprice AS weight_kg, CAST(l_quantity AS INTEGER) AS reps,
        CAST(round(l_tax * 100) AS INTEGER) + 2 AS rpe,
        CAST(round(l_discount * 100) AS INTEGER) * 30 AS rest_seconds FROM lineitem""",
    "exercises": f"""SELECT p_partkey AS id, p_name AS name, {SLUG.format(x="p_name")} AS slug,
        {case_map(BRAND, codes.MUSCLES, "full_body")} AS primary_muscle, lower(p_type) AS exercise_type,
        {case_map("p_size", codes.EQUIPMENT, "none")} AS equipment, 'intermediate' AS difficulty,
        p_type || ' ' || p_brand AS instructions FROM part""",
    "kevents": "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    "body_metrics": """SELECT event_id AS id, user_id AS athlete_id, ts AS measured_at, value AS weight_kg,
        k * CAST(0.5 AS DOUBLE) AS body_fat_pct, k + 40 AS resting_heart_rate,
        CAST(floor(k / 10) AS INTEGER) + 1 AS sleep_quality, CAST(floor(k / 12) AS INTEGER) + 1 AS stress_level,
        CAST(floor(k / 15) AS INTEGER) + 1 AS recovery_score, k * 120 AS steps,
        CASE WHEN event_type = 'view' THEN 60 + k END AS waist_cm,
        30 + k * CAST(0.25 AS DOUBLE) AS left_arm_cm,
        CASE WHEN event_type <> 'error' THEN 31 + k * CAST(0.125 AS DOUBLE) END AS right_arm_cm FROM kevents""",
    "nutrition_logs": """SELECT event_id AS id, user_id AS athlete_id, CAST(ts AS DATE) AS log_date,
        CASE event_type WHEN 'signup' THEN 'breakfast' WHEN 'click' THEN 'lunch' WHEN 'purchase' THEN 'dinner'
            WHEN 'view' THEN 'snack' ELSE event_type END AS meal_type,
        value AS calories, k * CAST(0.5 AS DOUBLE) AS protein_g, CAST(k AS DOUBLE) AS carbs_g,
        k * CAST(0.25 AS DOUBLE) AS fats_g, CASE WHEN k >= 5 THEN k * CAST(0.125 AS DOUBLE) END AS fiber_g,
        k * 10 AS water_ml FROM kevents""",
    "workout_log": """SELECT w.athlete_id, w.workout_date, e.name AS exercise, s.set_number,
        s.weight_kg AS weight, s.reps, s.rpe
        FROM workout_sets s JOIN workouts w ON s.workout_id = w.id JOIN exercises e ON s.exercise_id = e.id""",
    "set_rows": """SELECT s.*, w.athlete_id, w.workout_date, w.status, e.name AS exercise_name, e.slug,
        e.primary_muscle
        FROM workout_sets s JOIN workouts w ON s.workout_id = w.id JOIN exercises e ON s.exercise_id = e.id""",
}
NEEDS = {
    "body_metrics": ["kevents"],
    "nutrition_logs": ["kevents"],
    "workout_log": ["workout_sets", "workouts", "exercises"],
    "set_rows": ["workout_sets", "workouts", "exercises"],
}


def with_roles(names: str, body: str, /, **more: str) -> str:
    """``body`` with the named roles, and further expressions in order, in front of it."""
    wanted: list[str] = []
    for n in names.split():
        wanted += [*NEEDS.get(n, []), n]
    blocks = {n: ROLES[n] for n in dict.fromkeys(wanted)} | more
    ctes = ",\n".join(f"{n} AS ({sql})" for n, sql in blocks.items())
    return f"WITH {ctes}\n{body}"


def epley(w: str, r: str) -> str:
    return rnd(f"({w}) * (1 + CAST({r} AS DOUBLE) / 30)", 1)
