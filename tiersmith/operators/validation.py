"""Rule-based validation: all rules of a table run in one aggregate over one scan."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiersmith.functions import codes
from tiersmith.functions.numeric import rounded
from tiersmith.operators.cleaning import quoted

RULES_PER_AGGREGATE = 100

DATE_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)
TYPE_FAMILIES: dict[str, tuple[type, ...]] = {
    "string": (T.StringType,),
    "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    "numeric": (T.NumericType,),
    "date": (*DATE_TYPES, T.StringType),
    "boolean": (T.BooleanType,),
}

# The rule set of the four datasets.
_NAMES = {"name": "string", "primary_muscle": "string", "exercise_type": "string",
          "equipment": "string", "difficulty": "string", "is_unilateral": "boolean"}
DEFAULT_RULES: dict[str, dict] = {
    "schema_rules": {
        "exercises": {
            "required_columns": ["name", "primary_muscle", "exercise_type", "equipment", "difficulty"],
            "column_types": _NAMES, "severity": "CRITICAL",
        },
        "workouts": {
            "required_columns": ["athlete_id", "workout_date", "status"],
            "column_types": {
                "athlete_id": "string", "workout_date": "date", "status": "string",
                "duration_minutes": "numeric", "total_volume_kg": "numeric", "energy_level": "integer",
            },
            "severity": "CRITICAL",
        },
        "body_metrics": {
            "required_columns": ["athlete_id", "measured_at", "weight_kg"],
            "column_types": {
                "athlete_id": "string", "measured_at": "date", "weight_kg": "numeric",
                "body_fat_pct": "numeric",
            },
            "severity": "CRITICAL",
        },
        "nutrition_logs": {
            "required_columns": ["athlete_id", "log_date", "meal_type", "calories"],
            "column_types": {
                "athlete_id": "string", "log_date": "date", "meal_type": "string",
                "calories": "integer", "protein_g": "numeric", "carbs_g": "numeric", "fats_g": "numeric",
            },
            "severity": "CRITICAL",
        },
    },
    "business_rules": {
        "exercises": [
            {"rule": "name_not_empty", "column": "name", "check": "not_empty", "severity": "CRITICAL"},
            {"rule": "valid_muscle_group", "column": "primary_muscle", "check": "in_set",
             "allowed_values": [m[0] for m in codes.MUSCLE_GROUPS], "severity": "CRITICAL"},
        ],
        "workouts": [
            {"rule": "valid_status", "column": "status", "check": "in_set",
             "allowed_values": codes.WORKOUT_STATUSES, "severity": "CRITICAL"},
            {"rule": "reasonable_duration", "column": "duration_minutes", "check": "range",
             "min": 10, "max": 300, "severity": "WARNING"},
            {"rule": "energy_level_valid", "column": "energy_level", "check": "range",
             "min": 1, "max": 10, "severity": "WARNING"},
        ],
        "body_metrics": [
            {"rule": "weight_reasonable", "column": "weight_kg", "check": "range",
             "min": 30.0, "max": 300.0, "severity": "WARNING"},
            {"rule": "body_fat_reasonable", "column": "body_fat_pct", "check": "range",
             "min": 3.0, "max": 60.0, "severity": "WARNING"},
            {"rule": "heart_rate_reasonable", "column": "resting_heart_rate", "check": "range",
             "min": 30, "max": 120, "severity": "WARNING"},
        ],
        "nutrition_logs": [
            {"rule": "calories_non_negative", "column": "calories", "check": "min", "min": 0,
             "severity": "CRITICAL"},
            {"rule": "calories_reasonable", "column": "calories", "check": "max", "max": 5000,
             "severity": "WARNING"},
            {"rule": "protein_non_negative", "column": "protein_g", "check": "min", "min": 0,
             "severity": "CRITICAL"},
            {"rule": "valid_meal_type", "column": "meal_type", "check": "in_set",
             "allowed_values": codes.MEAL_TYPES, "severity": "CRITICAL"},
        ],
    },
    "freshness_rules": {
        "workouts": {"max_age_hours": 48, "severity": "WARNING"},
        "body_metrics": {"max_age_hours": 72, "severity": "INFO"},
        "nutrition_logs": {"max_age_hours": 48, "severity": "WARNING"},
    },
    "anomaly_detection": {
        "z_score_threshold": 3.0, "iqr_multiplier": 1.5, "min_sample_size": 10,
        "columns_to_monitor": {
            "body_metrics": ["weight_kg", "body_fat_pct", "resting_heart_rate"],
            "nutrition_logs": ["calories", "protein_g"],
            "workouts": ["total_volume_kg", "duration_minutes"],
        },
    },
}


@dataclass
class Check:
    """One result row to be. What is known beforehand is plain text, the rest is measured.

    ``failing`` and ``total`` are aggregates; without them the check has a fixed outcome or, for
    freshness, ``fresh`` and the age decide.
    """

    rule_name: str
    column: str | None
    severity: str
    message: str = ""
    passed: bool | None = None
    failing: Column | None = None
    total: Column | None = None
    fresh: Column | None = None
    age_hours: Column | None = None
    age_text: Column | None = None


def required_columns(df: DataFrame, cols: list[str], severity: str) -> list[Check]:
    out = []
    for c in cols:
        found = c in df.columns
        text = f"Required column '{c}' {'found' if found else 'MISSING'}"
        out.append(Check(f"schema_required_column_{c}", c, severity, text, found))
    return out


def column_types(df: DataFrame, expected: dict[str, str]) -> list[Check]:
    out = []
    for c, kind in expected.items():
        if c not in df.columns:
            continue
        actual = df.schema[c].dataType
        fits = isinstance(actual, TYPE_FAMILIES.get(kind, ()))
        text = f"Column '{c}' type: expected {kind}, got {actual.simpleString()}"
        out.append(Check(f"schema_type_{c}", c, "WARNING", text, fits))
    return out


def failing_condition(rule: dict) -> Column:
    """True on a row that breaks the rule; null or false otherwise, also for null values."""
    c, kind = quoted(rule["column"]), rule["check"]
    low, high = rule.get("min"), rule.get("max")
    if kind == "not_empty":
        return F.trim(c.cast("string")) == ""
    if kind == "in_set":
        return ~c.cast("string").isin([str(v) for v in rule["allowed_values"]])
    if kind not in ("range", "min", "max"):
        raise ValueError(f"unknown check '{kind}'")
    value, bad = c.try_cast("double"), F.lit(False)
    if low is not None and kind in ("range", "min"):
        bad = bad | (value < low)
    if high is not None and kind in ("range", "max"):
        bad = bad | (value > high)
    return bad


def business_rules(df: DataFrame, rules: list[dict]) -> list[Check]:
    out = []
    for rule in rules:
        name, c = rule.get("rule", "unnamed"), rule["column"]
        severity = rule.get("severity", "WARNING")
        if c not in df.columns:
            text = f"Column '{c}' not found for rule '{name}'"
            out.append(Check(name, c, severity, text, passed=False))
            continue
        text = rule.get("description", f"{c} {rule['check']} check")
        failing = F.count_if(failing_condition(rule))
        out.append(Check(name, c, severity, text, failing=failing, total=F.count(quoted(c))))
    return out


def freshness(df: DataFrame, table_name: str, rule: dict, now: Column) -> list[Check]:
    """Age of the newest date. The date column is named by the rule, or the first typed one."""
    name, severity = f"freshness_{table_name}", rule.get("severity", "WARNING")
    typed = [f.name for f in df.schema.fields if isinstance(f.dataType, DATE_TYPES)]
    c = rule.get("column") or next((t for t in typed if not t.startswith("_")), None)
    if c is None or c not in df.columns:
        return [Check(name, None, "INFO", "No date column found for freshness check", passed=True)]
    limit = rule.get("max_age_hours", 48)
    seconds = F.unix_timestamp(now) - F.unix_timestamp(F.max(quoted(c).try_cast("timestamp")))
    age = rounded(seconds / 3600, 1)
    text = F.concat(F.lit("Data age: "), age, F.lit(f" hours (max allowed: {limit} hours)"))
    return [
        Check(
            name, c, severity, "No valid dates found for freshness check",
            fresh=F.coalesce(seconds <= limit * 3600, F.lit(False)), age_hours=age, age_text=text,
        )
    ]


def checks_for(df: DataFrame, table_name: str, rules: dict, now: Column) -> list[Check]:
    out: list[Check] = []
    schema = rules.get("schema_rules", {}).get(table_name)
    if schema:
        out += required_columns(df, schema.get("required_columns", []), schema.get("severity", "CRITICAL"))
        out += column_types(df, schema.get("column_types", {}))
    out += business_rules(df, rules.get("business_rules", {}).get(table_name, []))
    fresh = rules.get("freshness_rules", {}).get(table_name)
    if fresh:
        out += freshness(df, table_name, fresh, now)
    return out


RESULT_COLUMNS = [
    "rule_name", "table_name", "passed", "severity", "message", "failing_rows", "total_rows", "column",
    "age_hours", "checked_at",
]
_KNOWN = "array<struct<rule_name:string,column:string,severity:string,message:string,passed:boolean>>"


def _run(df: DataFrame, table_name: str, checks: list[Check], now: Column, by: list[str]) -> DataFrame:
    """All checks as one aggregate row, which is then turned into one row per check.

    What is known about the checks travels as one literal next to the arrays of measured values.
    """
    known = [
        {"rule_name": c.rule_name, "column": c.column, "severity": c.severity, "message": c.message, "passed": c.passed}
        for c in checks
    ]
    measured = {"failing": "0L", "total": "0L", "fresh": "CAST(NULL AS BOOLEAN)",
                "age_hours": "CAST(NULL AS DOUBLE)", "age_text": "CAST(NULL AS STRING)"}
    aggregates, arrays = [], []
    for part, absent in measured.items():
        cells = []
        for i, c in enumerate(checks):
            value = getattr(c, part)
            if value is not None:
                aggregates.append(value.alias(f"_{part}_{i}"))
            cells.append(absent if value is None else f"_{part}_{i}")
        arrays.append(F.expr(f"array({', '.join(cells)})").alias(part))
    # The row count keeps the aggregate alive where all checks are known beforehand.
    row = df.groupBy(*by).agg(F.count("*").alias("_rows"), *aggregates)
    zipped = row.select(*by, F.from_json(F.lit(json.dumps(known)), _KNOWN).alias("known"), *arrays).select(
        *by, F.explode(F.arrays_zip("known", *measured)).alias("_r")
    )
    return zipped.select(*by, "_r.known.*", *[f"_r.{part}" for part in measured]).select(
        *by,
        "rule_name",
        F.lit(table_name).alias("table_name"),
        F.coalesce("passed", "fresh", F.col("failing") == 0).alias("passed"),
        "severity",
        F.coalesce("age_text", "message").alias("message"),
        F.col("failing").alias("failing_rows"),
        F.col("total").alias("total_rows"),
        "column",
        "age_hours",
        now.alias("checked_at"),
    )


def validate(
    df: DataFrame, table_name: str, rules: dict | None = None, now: Column | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """One result row per rule of the table, or per rule and partition with ``by``.

    Long rule lists are cut into several aggregates.
    """
    now = F.current_timestamp() if now is None else now
    checks = checks_for(df, table_name, DEFAULT_RULES if rules is None else rules, now)
    if not checks:
        raise KeyError(f"no rules for table '{table_name}'")
    parts = [
        _run(df, table_name, checks[i : i + RULES_PER_AGGREGATE], now, by or [])
        for i in range(0, len(checks), RULES_PER_AGGREGATE)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def invalid_samples(df: DataFrame, rules: list[dict], k: int = 5) -> DataFrame:
    """Up to k distinct offending values per ``in_set`` rule, smallest first."""
    enums = [r for r in rules if r["check"] == "in_set" and r["column"] in df.columns]
    held = df.select(
        *[F.when(failing_condition(r), quoted(r["column"]).cast("string")).alias(r["rule"]) for r in enums]
    )
    names = [r["rule"] for r in enums]
    bad = held.unpivot([], names, "rule_name", "value").filter(F.col("value").isNotNull()).distinct()
    first = Window.partitionBy("rule_name").orderBy("value")
    return (
        bad.withColumn("_r", F.row_number().over(first))
        .filter(F.col("_r") <= k)
        .groupBy("rule_name")
        .agg(F.sort_array(F.collect_list("value")).alias("invalid_values"))
    )


def severity_order(severity: Column) -> Column:
    return (
        F.when(severity == "CRITICAL", 0).when(severity == "WARNING", 1).when(severity == "INFO", 2).otherwise(3)
    )


def failed_first(results: DataFrame) -> DataFrame:
    """Listing order: failures by severity, then passed checks."""
    return results.orderBy("passed", severity_order(F.col("severity")), "table_name", "rule_name")
