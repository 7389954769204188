"""Queries over profiling, validation, anomalies, scores and contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import in_list, rnd, with_roles
from tiersmith.functions import codes
from tiersmith.operators import anomalies, contracts, profiling, scoring, validation
from tiersmith.plans import medallion, roles
from tiersmith.session import scratch_dir, table
from tiersmith.sources import store

NOW = "2024-02-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


# ---- profiles ----


@query(
    "F1_table_profile",
    with_roles(
        "body_metrics",
        f"""SELECT 'body_metrics' AS table_name, COUNT(*) AS row_count, 3 AS column_count,
            COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM narrow)) AS duplicate_rows, 0 AS empty_columns,
            2 AS columns_with_nulls, 2 * COUNT(*) - COUNT(waist_cm) - COUNT(right_arm_cm) AS null_cells,
            {rnd("100 * CAST(2 * COUNT(*) - COUNT(waist_cm) - COUNT(right_arm_cm) AS DOUBLE) / (3 * COUNT(*))", 2)} AS null_pct
            FROM narrow""",
        narrow="SELECT steps, waist_cm, right_arm_cm FROM body_metrics",
    ),
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = roles.body_metrics(spark, sf_dir).select("steps", "waist_cm", "right_arm_cm")
    return profiling.table_profile(metrics, "body_metrics")


@query(
    "F1_table_profile_documents",
    """SELECT 'documents' AS table_name, COUNT(*) AS row_count, 4 AS column_count,
       COUNT(*) - COUNT(DISTINCT (text, lang, source, n_chars)) AS duplicate_rows, 0 AS empty_columns,
       0 AS columns_with_nulls, CAST(0 AS BIGINT) AS null_cells, CAST(0 AS DOUBLE) AS null_pct FROM documents""",
)
def table_profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.table_profile(table(spark, sf_dir, "documents").drop("doc_id"), "documents")


def _column_profile_sql(cols: dict[str, str], source: str) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS null_count,
        {rnd(f"100 * CAST(COUNT(*) - COUNT({c}) AS DOUBLE) / COUNT(*)", 2)} AS null_pct,
        COUNT(DISTINCT {c}) AS unique_count,
        {rnd(f"100 * CAST(COUNT(DISTINCT {c}) AS DOUBLE) / COUNT(*)", 2)} AS unique_pct, '{t}' AS dtype FROM {source}"""
        for c, t in cols.items()
    ]
    return " UNION ALL ".join(parts)


PROFILE_COLUMNS = {
    "id": "bigint", "athlete_id": "bigint", "weight_kg": "double", "waist_cm": "int", "steps": "int",
}


@query("F2_column_profile", with_roles("body_metrics", _column_profile_sql(PROFILE_COLUMNS, "body_metrics")))
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.column_profile(roles.body_metrics(spark, sf_dir), list(PROFILE_COLUMNS))


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _numeric_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", MIN({c}) AS min, MAX({c}) AS max,
        {rnd(f"favg(CAST({c} AS DOUBLE))", 4)} AS mean,
        {rnd(f"stddev_samp({c})", 4)} AS std, COUNT(*) FILTER (WHERE {c} = 0) AS zeros,
        COUNT(*) FILTER (WHERE {c} < 0) AS negatives, {rnd(f"quantile_cont({c}, 0.25)", 4)} AS q25,
        {rnd(f"quantile_cont({c}, 0.5)", 4)} AS median, {rnd(f"quantile_cont({c}, 0.75)", 4)} AS q75 FROM lineitem"""


@query("F3_numeric_profile", " UNION ALL ".join(map(_numeric_sql, NUMERIC)))
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.numeric_profile(table(spark, sf_dir, "lineitem"), NUMERIC)


def _string_sql(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(MIN(length({c})) AS INTEGER) AS min_length,
        CAST(MAX(length({c})) AS INTEGER) AS max_length,
        {rnd(f"CAST(SUM(length({c})) AS DOUBLE) / COUNT({c})", 1)} AS avg_length,
        COUNT(*) FILTER (WHERE {c} = '') AS empty_strings FROM documents"""


@query("F4_string_profile", " UNION ALL ".join(map(_string_sql, ["text", "lang", "source"])))
def string_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.string_profile(table(spark, sf_dir, "documents"))


def _top_sql(c: str) -> str:
    return f"""(SELECT '{c}' AS "column", {c} AS value, COUNT(*) AS n,
        CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {c}) AS INTEGER) AS rank FROM orders
        GROUP BY {c} ORDER BY n DESC, value LIMIT 5)"""


@query("F5_top_values", " UNION ALL ".join(map(_top_sql, ["o_orderstatus", "o_orderpriority"])))
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.top_values(table(spark, sf_dir, "orders"))


@query(
    "F6_date_profile",
    """SELECT 'l_shipdate' AS "column", MIN(l_shipdate) AS min_date, MAX(l_shipdate) AS max_date,
       CAST(date_diff('day', MIN(l_shipdate), MAX(l_shipdate)) AS BIGINT) AS range_days FROM lineitem""",
)
def date_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.date_profile(table(spark, sf_dir, "lineitem"))


@query(
    "F7_boolean_profile",
    f"""SELECT 'returned' AS "column", COUNT(*) FILTER (WHERE l_returnflag = 'R') AS true_count,
        COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS false_count,
        {rnd("100 * CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / COUNT(*)", 2)} AS true_pct FROM lineitem""",
)
def boolean_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "lineitem").select((F.col("l_returnflag") == "R").alias("returned"))
    return profiling.boolean_profile(flags)


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_name",
        F.lit(None).cast("string").alias("empty"),
        F.when(F.col("c_acctbal") < 0, "debt").alias("rare"),
        F.lit("x").alias("constant"),
        "c_mktsegment",
    )


@query(
    "F8_profile_warnings",
    """SELECT DISTINCT 'empty' AS "column", 'CRITICAL' AS severity FROM customer
       UNION ALL SELECT DISTINCT 'constant', 'INFO' FROM customer
       UNION ALL SELECT DISTINCT 'rare', 'INFO' FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT 'rare', 'WARNING' FROM customer HAVING COUNT(*) FILTER (WHERE c_acctbal < 0) * 2 < COUNT(*)
       UNION ALL SELECT 'c_name', 'INFO' FROM customer HAVING COUNT(DISTINCT c_name) * 100 > 95 * COUNT(*)""",
)
def profile_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = profiling.column_profile(_mixed(spark, sf_dir))
    return profiling.profile_warnings(profile).drop("warning")


# ---- rules ----

RESULT = ["rule_name", "table_name", "passed", "severity", "failing_rows", "total_rows", "column"]


def _rules_sql(source: str, rules: list[dict]) -> str:
    """The business rules of a table over ``source``, one result row per rule."""
    parts = []
    for r in rules:
        c, kind = r["column"], r["check"]
        bad = {
            "not_empty": f"trim(CAST({c} AS VARCHAR)) = ''",
            "in_set": f"CAST({c} AS VARCHAR) NOT IN {in_list(r.get('allowed_values', ['']))}",
            "range": f"{c} < {r.get('min')} OR {c} > {r.get('max')}",
            "min": f"{c} < {r.get('min')}",
            "max": f"{c} > {r.get('max')}",
        }[kind]
        parts.append(
            f"""SELECT '{r["rule"]}' AS rule_name, '{source}' AS table_name, COUNT(*) FILTER (WHERE {bad}) = 0 AS passed,
            '{r["severity"]}' AS severity, COUNT(*) FILTER (WHERE {bad}) AS failing_rows, COUNT({c}) AS total_rows,
            '{c}' AS "column" FROM {source}"""
        )
    return " UNION ALL ".join(parts)


DATASETS = {
    "exercises": roles.exercises, "workouts": roles.workouts, "body_metrics": roles.body_metrics,
    "nutrition_logs": roles.nutrition_logs,
}
ROLE_NAMES = " ".join(DATASETS)


def _business(name: str, table_name: str, rules: list[dict]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        data = DATASETS[table_name](spark, sf_dir)
        return validation.validate(data, table_name, {"business_rules": {table_name: rules}}, now()).select(*RESULT)

    query(name, with_roles(table_name, _rules_sql(table_name, rules)))(run)


_business(
    "F11_not_empty",
    "exercises",
    [
        {"rule": "name_not_empty", "column": "name", "check": "not_empty", "severity": "CRITICAL"},
        {"rule": "slug_not_empty", "column": "slug", "check": "not_empty", "severity": "WARNING"},
    ],
)
_business(
    "F14_range",
    "body_metrics",
    validation.DEFAULT_RULES["business_rules"]["body_metrics"]
    + [{"rule": "waist", "column": "waist_cm", "check": "range", "min": 65, "max": 140, "severity": "INFO"}],
)
_business(
    "F15_min",
    "nutrition_logs",
    [
        {"rule": "calories_non_negative", "column": "calories", "check": "min", "min": 0, "severity": "CRITICAL"},
        {"rule": "some_fiber", "column": "fiber_g", "check": "min", "min": 1, "severity": "INFO"},
    ],
)
_business(
    "F16_max",
    "nutrition_logs",
    [
        {"rule": "calories_reasonable", "column": "calories", "check": "max", "max": 5000, "severity": "WARNING"},
        {"rule": "light_meal", "column": "calories", "check": "max", "max": 200, "severity": "INFO"},
    ],
)
MEAL_RULE = {
    "rule": "valid_meal_type", "column": "meal_type", "check": "in_set",
    "allowed_values": codes.MEAL_TYPES, "severity": "CRITICAL",
}
_business("F13_in_set", "nutrition_logs", [MEAL_RULE])


@query(
    "F13_in_set_samples",
    with_roles(
        "nutrition_logs",
        f"""SELECT 'valid_meal_type' AS rule_name, string_agg(meal_type, ',' ORDER BY meal_type) AS invalid_values
            FROM (SELECT DISTINCT meal_type FROM nutrition_logs WHERE meal_type NOT IN {in_list(codes.MEAL_TYPES)}
                  ORDER BY meal_type LIMIT 5)""",
    ),
)
def in_set_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = validation.invalid_samples(roles.nutrition_logs(spark, sf_dir), [MEAL_RULE])
    return found.withColumn("invalid_values", F.array_join("invalid_values", ","))


def _age(column: str, source: str) -> str:
    return f"(epoch(TIMESTAMP '{NOW}') - epoch(date_trunc('second', CAST(MAX({column}) AS TIMESTAMP)))) / 3600"


FRESHNESS = {"workouts": ("workout_date", 48), "body_metrics": ("measured_at", 72), "nutrition_logs": ("log_date", 48)}


@query(
    "F17_freshness",
    with_roles(
        "workouts body_metrics nutrition_logs",
        " UNION ALL ".join(
            f"""SELECT 'freshness_{t}' AS rule_name, '{c}' AS "column", {_age(c, t)} <= {limit} AS passed,
            {rnd(_age(c, t), 1)} AS age_hours FROM {t}"""
            for t, (c, limit) in FRESHNESS.items()
        ),
    ),
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = {"freshness_rules": validation.DEFAULT_RULES["freshness_rules"]}
    parts = [validation.validate(DATASETS[t](spark, sf_dir), t, fresh, now()) for t in FRESHNESS]
    return reduce(DataFrame.unionByName, parts).select("rule_name", "column", "passed", "age_hours")


def all_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [validation.validate(load(spark, sf_dir), t, None, now()) for t, load in DATASETS.items()]
    return reduce(DataFrame.unionByName, parts)


# Which of the schema rules hold is a fact about the declared types, so it is stated here.
FAILED_TYPES = {
    "exercises": {"is_unilateral": None}, "workouts": {"athlete_id": False}, "body_metrics": {"athlete_id": False},
    "nutrition_logs": {"athlete_id": False, "calories": False},
}


def _schema_rows() -> str:
    rows = []
    for t, schema in validation.DEFAULT_RULES["schema_rules"].items():
        for c in schema["required_columns"]:
            rows.append((f"schema_required_column_{c}", t, True, schema["severity"], c))
        for c in schema["column_types"]:
            if FAILED_TYPES[t].get(c, True) is not None:
                rows.append((f"schema_type_{c}", t, FAILED_TYPES[t].get(c, True), "WARNING", c))
    values = ", ".join(f"('{n}', '{t}', {str(p).upper()}, '{s}', '{c}')" for n, t, p, s, c in rows)
    return f"""SELECT n AS rule_name, t AS table_name, p AS passed, s AS severity, 0 AS failing_rows,
        0 AS total_rows, c AS "column" FROM (VALUES {values}) v(n, t, p, s, c)"""


RESULTS_SQL = " UNION ALL ".join(
    [_schema_rows()]
    + [_rules_sql(t, rules) for t, rules in validation.DEFAULT_RULES["business_rules"].items()]
    + [
        f"""SELECT 'freshness_{t}', '{t}', {_age(c, t)} <= {limit}, '{validation.DEFAULT_RULES["freshness_rules"][t]["severity"]}',
        0, 0, '{c}' FROM {t}"""
        for t, (c, limit) in FRESHNESS.items()
    ]
)


@query("F9_F10_F18_rule_set", with_roles(ROLE_NAMES, RESULTS_SQL))
def rule_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_results(spark, sf_dir).select(*RESULT)


@query(
    "F32_failed_checks_first",
    with_roles(
        ROLE_NAMES,
        """SELECT table_name, rule_name, severity, passed, CAST(row_number() OVER (ORDER BY passed,
             CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'INFO' THEN 2 ELSE 3 END,
             table_name, rule_name) AS INTEGER) - 1 AS position FROM results""",
        results=RESULTS_SQL,
    ),
)
def failed_checks_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing order made visible: one row per rule, so the position is cheap to number."""
    listed = validation.failed_first(all_results(spark, sf_dir)).withColumn("_at", F.monotonically_increasing_id())
    place = (F.row_number().over(Window.orderBy("_at")) - 1).alias("position")
    return listed.select("table_name", "rule_name", "severity", "passed", place)


# ---- anomalies ----

MONITORED = validation.DEFAULT_RULES["anomaly_detection"]["columns_to_monitor"]


def _column_values(columns: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {t} WHERE {c} IS NOT NULL"
        for t, cols in columns.items()
        for c in cols
    )


STATS_SQL = """SELECT table_name, "column", COUNT(*) AS n, favg(v) AS mean,
    stddev_samp(v) AS std, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
    FROM vals GROUP BY "column", table_name"""
FOUND_SQL = f"""SELECT s.table_name, s."column", MAX(n) AS total_count, MAX(mean) AS mean, MAX(std) AS std,
    MAX(abs(v - mean) / NULLIF(std, 0)) AS max_z, MAX(q1) AS q1, MAX(q3) AS q3,
    COUNT(*) FILTER (WHERE abs(v - mean) / NULLIF(std, 0) > 3) AS z,
    COUNT(*) FILTER (WHERE q3 > q1 AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))) AS i
    FROM vals JOIN stats s USING (table_name, "column") GROUP BY ALL"""


def _anomaly_sql(columns: dict[str, list[str]], body: str) -> str:
    return with_roles(" ".join(columns), body, vals=_column_values(columns), stats=STATS_SQL, found=FOUND_SQL)


LINE_COLUMNS = {"workout_sets": ["weight_kg", "reps", "rpe", "rest_seconds"]}


def line_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.detect(roles.workout_sets(spark, sf_dir), LINE_COLUMNS["workout_sets"])


@query(
    "F19_zscore_outliers",
    _anomaly_sql(
        LINE_COLUMNS,
        f"""SELECT "column", z AS anomaly_count, total_count, {rnd("mean", 4)} AS mean, {rnd("std", 4)} AS std,
            {rnd("max_z", 4)} AS max_z_score FROM found""",
    ),
)
def zscore_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_anomalies(spark, sf_dir).filter(F.col("method") == "z_score")
    stats = [F.col("stats")[c].alias(c) for c in ("mean", "std", "max_z_score")]
    return found.select("column", "anomaly_count", "total_count", *stats)


@query(
    "F20_iqr_outliers",
    _anomaly_sql(
        {"body_metrics": ["weight_kg", "steps"]},
        f"""SELECT "column", i AS anomaly_count, total_count, {rnd("q1", 4)} AS q1, {rnd("q3", 4)} AS q3,
            {rnd("q3 - q1", 4)} AS iqr, {rnd("q1 - 1.5 * (q3 - q1)", 4)} AS lower_fence,
            {rnd("q3 + 1.5 * (q3 - q1)", 4)} AS upper_fence FROM found""",
    ),
)
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomalies.detect(roles.body_metrics(spark, sf_dir), ["weight_kg", "steps"])
    stats = [F.col("stats")[c].alias(c) for c in ("q1", "q3", "iqr", "lower_fence", "upper_fence")]
    return found.filter(F.col("method") == "iqr").select("column", "anomaly_count", "total_count", *stats)


def all_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.detect_tables({t: (DATASETS[t](spark, sf_dir), cols) for t, cols in MONITORED.items()})


@query(
    "F21_monitored_columns",
    _anomaly_sql(
        MONITORED,
        f"""SELECT table_name, "column", method, CASE WHEN total_count >= 10 THEN anomaly_count END AS anomaly_count,
            total_count, threshold, CASE WHEN total_count >= 10
            THEN {rnd("100 * CAST(anomaly_count AS DOUBLE) / total_count", 2)} END AS anomaly_pct,
            CASE WHEN total_count >= 10 THEN 'checked' ELSE 'too few values' END AS status FROM (
              SELECT table_name, "column", 'z_score' AS method, z AS anomaly_count, total_count,
                CAST(3 AS DOUBLE) AS threshold FROM found
              UNION ALL SELECT table_name, "column", 'iqr', i, total_count, CAST(1.5 AS DOUBLE) FROM found)""",
    ),
)
def monitored_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_anomalies(spark, sf_dir).drop("stats")


@query(
    "F21_flagged_rows",
    with_roles(
        "body_metrics",
        """SELECT id, "column", v AS value, coalesce(abs(v - mean) / NULLIF(std, 0) > 3, FALSE) AS is_z_score,
             q3 > q1 AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS is_iqr
           FROM vals JOIN stats USING (table_name, "column") WHERE is_z_score OR is_iqr""",
        vals="""SELECT id, 'body_metrics' AS table_name, 'weight_kg' AS "column", weight_kg AS v FROM body_metrics
            UNION ALL SELECT id, 'body_metrics', 'steps', steps FROM body_metrics""",
        stats=STATS_SQL,
    ),
)
def flagged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies.flagged_rows(roles.body_metrics(spark, sf_dir), ["id"], ["weight_kg", "steps"])


# ---- scores ----


def _null_sql() -> str:
    parts = []
    for t, nullable in {
        "exercises": (8, []), "workouts": (9, []), "body_metrics": (13, ["waist_cm", "right_arm_cm"]),
        "nutrition_logs": (10, ["fiber_g"]),
    }.items():
        width, cols = nullable
        cells = " + ".join([f"COUNT(*) - COUNT({c})" for c in cols]) or "0"
        parts.append(
            f"""SELECT '{t}' AS table_name, COUNT(*) AS row_count,
            {rnd(f"100 * CAST({cells} AS DOUBLE) / (COUNT(*) * {width})", 2)} AS null_pct FROM {t}"""
        )
    return " UNION ALL ".join(parts)


CONSISTENT = "((CASE WHEN rule_name LIKE 'schema_type%' THEN 1 ELSE 0 END) + (CASE WHEN contains(rule_name, 'in_set') OR contains(rule_name, 'valid_') THEN 1 ELSE 0 END))"


def counts_sql(results: str, by: str) -> str:
    business = "NOT starts_with(rule_name, 'schema_') AND NOT starts_with(rule_name, 'freshness_')"
    return f"""SELECT {by}, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE NOT passed) AS failed_checks,
        COUNT(*) FILTER (WHERE NOT passed AND starts_with(rule_name, 'schema_required_column')) AS missing,
        COUNT(*) FILTER (WHERE {business}) AS b, COUNT(*) FILTER (WHERE {business} AND NOT passed) AS bf,
        SUM({CONSISTENT}) AS c, SUM(CASE WHEN passed THEN 0 ELSE {CONSISTENT} END) AS cf,
        COUNT(*) FILTER (WHERE NOT passed AND starts_with(rule_name, 'freshness_')) AS stale
        FROM {results} GROUP BY {by}"""


def parts_sql(source: str, by: str, extra: str = "") -> str:
    """Dimension scores from counts; ``source`` has the counts, null share, anomalies and age."""
    return f"""SELECT {by}, row_count, failed_checks, total_checks{extra},
        greatest(100 - least(missing * 15, 60) - least(null_pct * CAST(0.8 AS DOUBLE), 40), 0) AS completeness,
        greatest(100 * coalesce(CAST(b - bf AS DOUBLE) / NULLIF(b, 0), 1)
          - least(coalesce(CAST(found AS DOUBLE) / NULLIF(checked, 0), 0) * 100, 30), 0) AS accuracy,
        100 * coalesce(CAST(c - cf AS DOUBLE) / NULLIF(c, 0), 1) AS consistency,
        CAST(CASE WHEN stale = 0 THEN 100 WHEN age IS NULL OR age > 168 THEN 30 WHEN age > 72 THEN 60 ELSE 80 END
          AS DOUBLE) AS timeliness FROM {source}"""


OVERALL = (
    "CAST(0.3 AS DOUBLE) * completeness + CAST(0.3 AS DOUBLE) * accuracy + CAST(0.2 AS DOUBLE) * consistency"
    " + CAST(0.2 AS DOUBLE) * timeliness"
)
GRADE = """CASE WHEN overall_score >= 95 THEN 'A+' WHEN overall_score >= 90 THEN 'A' WHEN overall_score >= 85 THEN 'B+'
    WHEN overall_score >= 80 THEN 'B' WHEN overall_score >= 70 THEN 'C' WHEN overall_score >= 60 THEN 'D' ELSE 'F' END"""


def _score_sql(body: str) -> str:
    ages = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {_age(c, t)} AS age FROM {t}" for t, (c, _) in FRESHNESS.items())
    return with_roles(
        ROLE_NAMES,
        body,
        results=RESULTS_SQL,
        vals=_column_values(MONITORED),
        stats=STATS_SQL,
        found=FOUND_SQL,
        counts=counts_sql("results", "table_name"),
        nulls=_null_sql(),
        ages=ages,
        bad="SELECT table_name, SUM(z + i) AS found, SUM(2 * total_count) AS checked FROM found WHERE total_count >= 10 GROUP BY table_name",
        merged="SELECT * FROM nulls LEFT JOIN counts USING (table_name) LEFT JOIN bad USING (table_name) LEFT JOIN ages USING (table_name)",
        dims=parts_sql("merged", "table_name", ", coalesce(found, 0) AS anomalies_found"),
        scored=f"SELECT *, {rnd(OVERALL, 2)} AS overall_score FROM dims",
        scores=f"SELECT *, {GRADE} AS grade FROM scored",
    )


def all_scores(spark: SparkSession, sf_dir: str, with_anomalies: bool = True) -> DataFrame:
    profiles = [
        profiling.null_share(load(spark, sf_dir), []).withColumn("table_name", F.lit(t))
        for t, load in DATASETS.items()
    ]
    found = all_anomalies(spark, sf_dir) if with_anomalies else None
    return scoring.score(all_results(spark, sf_dir), found, reduce(DataFrame.unionByName, profiles))


def _dimension(name: str, part: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return all_scores(spark, sf_dir, part == "accuracy").select("table_name", f"{part}_score")

    query(name, _score_sql(f"SELECT table_name, {rnd(part, 2)} AS {part}_score FROM scores"))(run)


_dimension("F22_completeness", "completeness")
_dimension("F23_accuracy", "accuracy")
_dimension("F24_consistency", "consistency")
_dimension("F25_timeliness", "timeliness")


@query(
    "F26_overall_score_and_grade",
    _score_sql(
        """SELECT table_name, overall_score, grade, row_count, failed_checks, total_checks,
           CAST(anomalies_found AS BIGINT) AS anomalies_found FROM scores"""
    ),
)
def overall_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_scores(spark, sf_dir).select(
        "table_name", "overall_score", "grade", "row_count", "failed_checks", "total_checks", "anomalies_found"
    )


@query(
    "F27_quality_gate",
    _score_sql(
        """SELECT table_name, overall_score >= 50 AS passes, CASE WHEN overall_score < 50 THEN 'CRITICAL'
           WHEN overall_score < 70 THEN 'WARNING' END AS alert FROM scores"""
    ),
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.gate(all_scores(spark, sf_dir)).select("table_name", "passes", "alert")


@query(
    "F33_quality_only_run",
    _score_sql("SELECT table_name, row_count, failed_checks, total_checks, overall_score, grade FROM scores"),
)
def quality_only_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store all four datasets as silver, then score what is stored, without ingesting anything."""
    root = scratch_dir(spark, "silver")
    for name, load in DATASETS.items():
        store.write_silver(load(spark, sf_dir), root, "file_drop", name)
    scores = medallion.quality_only(spark, root, {"file_drop": list(DATASETS)}, now())
    return scores.select("table_name", "row_count", "failed_checks", "total_checks", "overall_score", "grade")


# ---- contracts ----


def _violation_sql(table_name: str, key: str) -> str:
    parts = []
    for f in contracts.CONTRACTS[table_name]:
        def arm(bad: str, message: str, name: str = f.name) -> str:
            return f"""SELECT {key}, '{name}' AS field, '{message}' AS message, CAST({name} AS VARCHAR) AS value
                FROM {table_name} WHERE {bad}"""

        if f.required:
            parts.append(arm(f"{f.name} IS NULL", "Field required"))
        if f.min_length is not None:
            parts.append(arm(f"length(CAST({f.name} AS VARCHAR)) < {f.min_length}", f"Shorter than {f.min_length}"))
        if f.allowed is not None:
            parts.append(arm(f"{f.name} NOT IN {in_list(f.allowed)}", "Value not allowed"))
        if f.ge is not None:
            parts.append(arm(f"{f.name} < {f.ge}", f"Less than {f.ge}"))
        if f.le is not None:
            parts.append(arm(f"{f.name} > {f.le}", f"Greater than {f.le}"))
    return " UNION ALL ".join(parts)


CONTRACTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, * FROM ({_violation_sql(t, 'id')})" for t in DATASETS
)


@query("F28_row_contracts", with_roles(ROLE_NAMES, CONTRACTS_SQL))
def row_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        contracts.violations(load(spark, sf_dir), t, ["id"]).withColumn("table_name", F.lit(t))
        for t, load in DATASETS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "F29_contract_summary",
    with_roles(
        ROLE_NAMES,
        f"""SELECT t.table_name, total_rows, total_rows - coalesce(bad, 0) AS valid_rows,
            coalesce(found, 0) AS violation_count,
            {rnd("100 * CAST(coalesce(bad, 0) AS DOUBLE) / total_rows", 2)} AS violation_rate_pct,
            coalesce(bad, 0) = 0 AS passed FROM totals t LEFT JOIN (
              SELECT table_name, COUNT(*) AS found, COUNT(DISTINCT id) AS bad FROM broken GROUP BY table_name) b
            ON b.table_name = t.table_name""",
        broken=CONTRACTS_SQL,
        totals=" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS total_rows FROM {t}" for t in DATASETS),
    ),
)
def contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [contracts.summary(load(spark, sf_dir), t) for t, load in DATASETS.items()]
    return reduce(DataFrame.unionByName, parts)


@query("F30_contract_on_sample")
def contract_on_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = roles.body_metrics(spark, sf_dir)
    return contracts.violations(metrics, "body_metrics", ["id"], sample_size=100)


@query(
    "F31_quarantine_split",
    with_roles(
        "nutrition_logs",
        f"""SELECT id, meal_type NOT IN {in_list(codes.MEAL_TYPES)} AS quarantined,
            CASE WHEN meal_type NOT IN {in_list(codes.MEAL_TYPES)} THEN 'meal_type: Value not allowed' END AS reasons
            FROM nutrition_logs""",
    ),
)
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = contracts.quarantine(roles.nutrition_logs(spark, sf_dir), contracts.contract("nutrition_logs"))
    return good.select("id", F.lit(False).alias("quarantined"), F.lit(None).cast("string").alias("reasons")).unionByName(
        bad.select("id", F.lit(True).alias("quarantined"), F.array_join("_reasons", "; ").alias("reasons"))
    )
