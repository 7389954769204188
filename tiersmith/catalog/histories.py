"""Queries over run, score and alert history, and the streams.

The history is made by scoring every day of the nutrition logs as a partition of its own; the run log
has one row per day and event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiersmith.catalog.quality import GRADE, OVERALL, counts_sql, parts_sql
from tiersmith.catalog.registry import query
from tiersmith.catalog.sqltext import avg, in_list, rnd, with_roles
from tiersmith.functions import codes
from tiersmith.operators import contracts, history, profiling, scoring, validation
from tiersmith.plans import roles
from tiersmith.session import scratch_dir, table
from tiersmith.streaming import arrivals, changes

NOW = "2024-02-01 00:00:00"
BY = ["meal_type", "log_date"]
RULES = {
    "schema_rules": {"meals": {"required_columns": ["calories", "sodium_mg"], "column_types": {"calories": "numeric"}}},
    "business_rules": {
        "meals": [
            {"rule": "valid_meal_type", "column": "meal_type", "check": "in_set",
             "allowed_values": codes.MEAL_TYPES, "severity": "CRITICAL"},
            {"rule": "light_meals", "column": "calories", "check": "max", "max": 300, "severity": "WARNING"},
            {"rule": "some_calories", "column": "calories", "check": "min", "min": 1, "severity": "WARNING"},
            {"rule": "some_fiber", "column": "fiber_g", "check": "range", "min": 1, "max": 12, "severity": "INFO"},
        ]
    },
    "freshness_rules": {"meals": {"max_age_hours": 48, "column": "log_date", "severity": "WARNING"}},
}


def day_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score history: one score per meal type (as the table) and day (as the time of scoring)."""
    logs = roles.nutrition_logs(spark, sf_dir)
    # The grouping columns are also what two rules look at, so they travel twice.
    held = logs.withColumns({"part": F.col("meal_type"), "day": F.col("log_date")})
    by = ["part", "day"]
    at = F.lit(NOW).cast("timestamp")
    results = validation.validate(held, "meals", RULES, at, by)
    profile = profiling.null_share(held, by, ["calories", "fiber_g"])
    scores = scoring.score(results, None, profile, by)
    return scores.withColumnsRenamed({"part": "table_name", "day": "scored_at"})


RULE_SQL = {
    "valid_meal_type": f"meal_type NOT IN {in_list(codes.MEAL_TYPES)}",
    "light_meals": "calories > 300", "some_calories": "calories < 1", "some_fiber": "fiber_g < 1 OR fiber_g > 12",
}
AGE = f"(epoch(TIMESTAMP '{NOW}') - epoch(CAST(scored_at AS TIMESTAMP))) / 3600"
RESULTS = " UNION ALL ".join(
    [
        f"SELECT '{r}' AS rule_name, meal_type AS table_name, log_date AS scored_at, COUNT(*) FILTER (WHERE {bad}) = 0 AS passed FROM nutrition_logs GROUP BY meal_type, log_date"
        for r, bad in RULE_SQL.items()
    ]
    + [
        f"SELECT '{r}', meal_type, log_date, {ok} FROM nutrition_logs GROUP BY meal_type, log_date"
        for r, ok in (("schema_required_column_calories", "TRUE"), ("schema_required_column_sodium_mg", "FALSE"),
                      ("schema_type_calories", "TRUE"))
    ]
    + [
        """SELECT 'freshness_meals', meal_type, log_date, epoch(TIMESTAMP '2024-02-01') - epoch(CAST(log_date AS TIMESTAMP)) <= 48 * 3600
           FROM nutrition_logs GROUP BY meal_type, log_date"""
    ]
)
SCORES = {
    "results": RESULTS,
    "counts": counts_sql("results", "table_name, scored_at"),
    "nulls": f"""SELECT meal_type AS table_name, log_date AS scored_at, COUNT(*) AS row_count,
        {rnd("100 * CAST(COUNT(*) - COUNT(fiber_g) AS DOUBLE) / (2 * COUNT(*))", 2)} AS null_pct
        FROM nutrition_logs GROUP BY meal_type, log_date""",
    "merged": f"""SELECT *, 0 AS found, 0 AS checked, {AGE} AS age FROM nulls JOIN counts USING (table_name, scored_at)""",
    "dims": parts_sql("merged", "table_name, scored_at"),
    "scored": f"SELECT *, {rnd(OVERALL, 2)} AS overall_score FROM dims",
    "scores": f"SELECT *, {GRADE} AS grade FROM scored",
}


def _scores_sql(body: str, **more: str) -> str:
    return with_roles("nutrition_logs", body, **SCORES, **more)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log: a run is a day, its sources are the event types."""
    day = F.col("ts").cast("date")
    events = table(spark, sf_dir, "events")
    return events.groupBy(day.cast("string").alias("run_id"), F.col("event_type").alias("source_name")).agg(
        F.when(F.max("value") > 250, "error").when(F.max("value") > 200, "partial").otherwise("success").alias("status"),
        F.min("ts").cast("timestamp").alias("started_at"),
        F.max("ts").cast("timestamp").alias("completed_at"),
        F.count("*").alias("rows_processed"),
        F.when(F.min("value") < 1, "bronze").otherwise("silver").alias("layer"),
    )


RUNS = {
    "runs": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, event_type AS source_name,
        CASE WHEN MAX(value) > 250 THEN 'error' WHEN MAX(value) > 200 THEN 'partial' ELSE 'success' END AS status,
        MIN(ts) AS started_at, MAX(ts) AS completed_at, COUNT(*) AS rows_processed,
        CASE WHEN MIN(value) < 1 THEN 'bronze' ELSE 'silver' END AS layer
        FROM events GROUP BY CAST(ts AS DATE), event_type"""
}


@query(
    "I1_latest_runs",
    with_roles("", "SELECT run_id, source_name, status FROM runs ORDER BY started_at DESC, run_id, source_name LIMIT 100", **RUNS),
)
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = history.latest_rows(runs(spark, sf_dir), "started_at", 100, ["run_id", "source_name"])
    return newest.select("run_id", "source_name", "status")


@query(
    "I2_status_summary",
    with_roles("", "SELECT status, COUNT(*) AS runs, CAST(SUM(rows_processed) AS BIGINT) AS rows_processed FROM runs GROUP BY status", **RUNS),
)
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.status_summary(runs(spark, sf_dir))


@query(
    "I2_run_kpis",
    with_roles(
        "",
        f"""SELECT COUNT(*) AS total_runs, COUNT(*) FILTER (WHERE status = 'success') AS success_runs,
            {rnd("100 * (CAST(COUNT(*) FILTER (WHERE status = 'success') AS DOUBLE) / COUNT(*))", 1)} AS success_rate,
            CAST(SUM(rows_processed) AS BIGINT) AS rows_processed FROM runs""",
        **RUNS,
    ),
)
def run_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.run_kpis(runs(spark, sf_dir))


@query(
    "I4_status_layer_filter",
    with_roles(
        "",
        "SELECT run_id, source_name, status, layer FROM runs WHERE status IN ('success', 'partial') AND layer IN ('bronze')",
        **RUNS,
    ),
)
def status_layer_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = history.filter_runs(runs(spark, sf_dir), ["success", "partial"], ["bronze"])
    return kept.select("run_id", "source_name", "status", "layer")


@query(
    "I5_latest_scores",
    _scores_sql(
        "SELECT table_name, scored_at, overall_score, grade FROM scores QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY scored_at DESC) = 1"
    ),
)
def latest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.latest_scores(day_scores(spark, sf_dir)).select("table_name", "scored_at", "overall_score", "grade")


@query(
    "I5_average_of_latest",
    _scores_sql(
        f"SELECT tables, avg_score, {GRADE.replace('overall_score', 'avg_score')} AS grade FROM avgs",
        latest="SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY scored_at DESC) = 1",
        avgs=f"SELECT COUNT(*) AS tables, {rnd(avg('overall_score'), 2)} AS avg_score FROM latest",
    ),
)
def average_of_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.average_of_latest(day_scores(spark, sf_dir))


@query(
    "I6_gate_counts",
    _scores_sql(
        """SELECT table_name, COUNT(*) FILTER (WHERE overall_score >= 70) AS passed,
           COUNT(*) FILTER (WHERE overall_score < 70) AS failed FROM scores GROUP BY table_name"""
    ),
)
def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.gate_counts(day_scores(spark, sf_dir), 70)


@query(
    "I7_score_delta",
    _scores_sql(
        f"""SELECT table_name, MAX(s) FILTER (WHERE r = 1) AS latest, coalesce(MAX(s) FILTER (WHERE r = 2), MAX(s) FILTER (WHERE r = 1))
            AS previous, {rnd("MAX(s) FILTER (WHERE r = 1) - coalesce(MAX(s) FILTER (WHERE r = 2), MAX(s) FILTER (WHERE r = 1))", 2)} AS delta
            FROM (SELECT table_name, overall_score AS s, row_number() OVER (PARTITION BY table_name ORDER BY scored_at DESC) AS r
                  FROM scores) GROUP BY table_name"""
    ),
)
def score_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.score_delta(day_scores(spark, sf_dir))


@query(
    "I8_dimension_trend",
    _scores_sql(
        " UNION ALL ".join(
            f"SELECT table_name, scored_at, '{d}_score' AS dimension, {rnd(d, 2)} AS score FROM scores"
            for d in ("completeness", "accuracy", "consistency", "timeliness")
        )
    ),
)
def dimension_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.dimension_trend(day_scores(spark, sf_dir)).orderBy("table_name", "scored_at")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = day_scores(spark, sf_dir).withColumn("scored_at", F.col("scored_at").cast("timestamp"))
    return history.score_alerts(scores)


SEVERITY = "CASE WHEN overall_score < 50 THEN 'CRITICAL' WHEN overall_score < 70 THEN 'WARNING' END"
ALERTS = {"alerts": f"SELECT {SEVERITY} AS severity, table_name, scored_at, overall_score, grade FROM scores WHERE overall_score < 70"}


@query(
    "I9_alert_counts",
    _scores_sql(
        """SELECT v.severity, COUNT(a.severity) AS alerts FROM (VALUES ('CRITICAL'), ('WARNING'), ('INFO')) v(severity)
           LEFT JOIN alerts a ON a.severity = v.severity GROUP BY v.severity""",
        **ALERTS,
    ),
)
def alert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.alert_counts(alerts(spark, sf_dir))


@query("I10_alert_retention", _scores_sql("SELECT COUNT(*) AS kept, MIN(CAST(scored_at AS TIMESTAMP)) AS oldest FROM alerts", **ALERTS))
def alert_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends the alerts to a log, which keeps all of them unless an age is given."""
    path = scratch_dir(spark, "alerts")
    alerts(spark, sf_dir).write.mode("append").parquet(path)
    kept = history.retained_alerts(spark.read.parquet(path))
    return kept.agg(F.count("*").alias("kept"), F.min("created_at").alias("oldest"))


@query(
    "I10_recent_critical_alerts",
    _scores_sql("SELECT CAST(scored_at AS TIMESTAMP) AS created_at, severity FROM alerts WHERE severity = 'CRITICAL' ORDER BY scored_at DESC LIMIT 20", **ALERTS),
)
def recent_critical_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.recent_alerts(alerts(spark, sf_dir), 20, "CRITICAL").select("created_at", "severity")


@query(
    "I11_threshold_alerts",
    _scores_sql(
        "SELECT severity, 'quality' AS source, CAST(scored_at AS TIMESTAMP) AS created_at, table_name || ' quality score: ' || overall_score || ' (' || grade || ')' AS message FROM alerts",
        **ALERTS,
    ),
)
def threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(spark, sf_dir).select("severity", "source", "created_at", "message")


@query(
    "I11_contract_alerts",
    with_roles(
        "nutrition_logs",
        f"""SELECT 'WARNING' AS severity, 'nutrition_logs' AS source, 'Contract violations in nutrition_logs: ' || bad ||
            ' violations (' || {rnd("100 * CAST(bad AS DOUBLE) / n", 2)} || '% of rows)' AS message
            FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE meal_type NOT IN {in_list(codes.MEAL_TYPES)}) AS bad FROM nutrition_logs)""",
    ),
)
def contract_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contracts.summary(roles.nutrition_logs(spark, sf_dir), "nutrition_logs")
    return history.contract_alerts(found, F.lit(NOW).cast("timestamp")).select("severity", "source", "message")


@query(
    "I12_run_totals",
    with_roles(
        "",
        f"""SELECT run_id, CAST(SUM(rows_processed) AS BIGINT) AS total_rows, COUNT(*) FILTER (WHERE status = 'error') AS total_errors,
            {rnd("(epoch_us(MAX(completed_at)) - epoch_us(MIN(started_at))) / CAST(1000000 AS DOUBLE)", 2)} AS duration_seconds
            FROM runs GROUP BY run_id""",
        **RUNS,
    ),
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.run_totals(runs(spark, sf_dir))


@query(
    "F27_gated_partitions",
    _scores_sql(
        """SELECT id, meal_type, log_date FROM nutrition_logs l WHERE EXISTS (SELECT 1 FROM scores s
           WHERE s.table_name = l.meal_type AND s.scored_at = l.log_date AND s.overall_score >= 70)"""
    ),
)
def gated_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the partitions that pass the gate."""
    scores = day_scores(spark, sf_dir).withColumnsRenamed({"table_name": "meal_type", "scored_at": "log_date"})
    logs = roles.nutrition_logs(spark, sf_dir).select("id", "meal_type", "log_date")
    return scoring.gated(logs, scores, BY, 70)


# ---- streams ----


@query("J1_file_arrival_ingest", "SELECT event_id, user_id, value, 'event_drop' AS _source_name, 'events.parquet' AS _source_file FROM events")
def file_arrival_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    stream = arrivals.arrivals(spark, f"{sf_dir}/events.parquet*", schema, "parquet")
    target, state = scratch_dir(spark, "landed"), scratch_dir(spark, "landed-state")
    arrivals.land(stream, "event_drop", target, state, drain=True).awaitTermination()
    landed = spark.read.parquet(target)
    return landed.select("event_id", "user_id", "value", "_source_name", "_source_file")


@query(
    "J2_change_feed_upsert",
    """SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id
       HAVING arg_max(event_type, event_id) <> 'error'""",
)
def change_feed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a per-user row; an error event deletes the row."""
    schema = table(spark, sf_dir, "events").schema
    feed = arrivals.arrivals(spark, f"{sf_dir}/events.parquet*", schema, "parquet")
    op = F.when(F.col("event_type") == "error", changes.DELETE).otherwise("UPSERT")
    rows = feed.select("user_id", "event_id", "value", op.alias("op"))
    log, state = scratch_dir(spark, "changes"), scratch_dir(spark, "changes-state")
    changes.upsert_batches(rows, ["user_id"], ["event_id"], log, state, drain=True).awaitTermination()
    base = scratch_dir(spark, "changes-base")
    changes.compact(spark, log, base, ["user_id"], ["event_id"])
    return changes.current_rows(changes.read_log(spark, log, base), ["user_id"], ["event_id"], "op")
