"""Run log, score history and alert tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiersmith.functions.numeric import mean, rounded
from tiersmith.operators.scoring import ALERT_BELOW, GATE_MINIMUM, grade

RUN_SCHEMA = (
    "run_id string, source_name string, dataset string, layer string, status string, "
    "started_at timestamp, completed_at timestamp, rows_processed bigint, error_message string"
)
# Fixed values.
SEVERITIES = ["CRITICAL", "WARNING", "INFO"]
DIMENSIONS = ["completeness_score", "accuracy_score", "consistency_score", "timeliness_score"]


def run_row(spark: SparkSession, **values) -> DataFrame:
    names = [f.split()[0] for f in RUN_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], RUN_SCHEMA)


def latest_rows(df: DataFrame, at: str, n: int, tie_break: list[str] | None = None) -> DataFrame:
    """The n newest rows: every task keeps its n best, nothing is sorted as a whole."""
    return df.orderBy(F.desc(at), *(tie_break or [])).limit(n)


def status_summary(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(
        F.count("*").alias("runs"), F.sum("rows_processed").alias("rows_processed")
    )


def run_kpis(runs: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "success")
    return runs.agg(
        F.count("*").alias("total_runs"),
        ok.alias("success_runs"),
        F.coalesce(rounded(100.0 * F.try_divide(ok, F.count("*")), 1), F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("rows_processed"),
    )


def run_totals(runs: DataFrame) -> DataFrame:
    """Per run: rows, sources in error, duration in seconds."""
    seconds = F.max("completed_at").cast("double") - F.min("started_at").cast("double")
    return runs.groupBy("run_id").agg(
        F.coalesce(F.sum("rows_processed"), F.lit(0)).alias("total_rows"),
        F.count_if(F.col("status") == "error").alias("total_errors"),
        rounded(seconds, 2).alias("duration_seconds"),
    )


def filter_runs(runs: DataFrame, statuses: list[str] | None = None, layers: list[str] | None = None) -> DataFrame:
    if statuses is not None:
        runs = runs.filter(F.col("status").isin(statuses))
    if layers is not None:
        runs = runs.filter(F.col("layer").isin(layers))
    return runs


def latest_scores(scores: DataFrame) -> DataFrame:
    """The newest score row of every table, as an aggregate."""
    row = F.struct(*scores.columns)
    return scores.groupBy("table_name").agg(F.max_by(row, "scored_at").alias("_row")).select("_row.*")


def average_of_latest(scores: DataFrame) -> DataFrame:
    average = latest_scores(scores).agg(
        F.count("*").alias("tables"), rounded(mean("overall_score"), 2).alias("avg_score")
    )
    return average.withColumn("grade", grade(F.col("avg_score")))


def gate_counts(scores: DataFrame, minimum: float = GATE_MINIMUM) -> DataFrame:
    s = F.col("overall_score")
    return scores.groupBy("table_name").agg(
        F.count_if(s >= minimum).alias("passed"), F.count_if(s < minimum).alias("failed")
    )


def score_delta(scores: DataFrame) -> DataFrame:
    """Latest and previous score per table; a table with one score has no change.

    The two newest rows per table are kept by a rank filter, which Spark applies in every map task
    before the shuffle.
    """
    newest = Window.partitionBy("table_name").orderBy(F.desc("scored_at"))
    two = scores.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= 2)
    last = F.max(F.when(F.col("_r") == 1, F.col("overall_score")))
    before = F.coalesce(F.max(F.when(F.col("_r") == 2, F.col("overall_score"))), last)
    return two.groupBy("table_name").agg(
        last.alias("latest"), before.alias("previous"), rounded(last - before, 2).alias("delta")
    )


def dimension_trend(scores: DataFrame) -> DataFrame:
    """(table, time, dimension, score) for the trend lines."""
    return scores.unpivot(["table_name", "scored_at"], DIMENSIONS, "dimension", "score")


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Alerts per severity. The known severities are listed with 0 where there is none."""
    zero = F.explode(F.array(*[F.lit(s) for s in SEVERITIES])).alias("severity")
    known = alerts.sparkSession.range(1).select(zero, F.lit(0).alias("_n"))
    seen = alerts.select(F.coalesce("severity", F.lit("INFO")).alias("severity"), F.lit(1).alias("_n"))
    return known.unionByName(seen).groupBy("severity").agg(F.sum("_n").alias("alerts"))


def recent_alerts(alerts: DataFrame, n: int = 20, severity: str | None = None) -> DataFrame:
    if severity is not None:
        alerts = alerts.filter(F.col("severity") == severity)
    return latest_rows(alerts, "created_at", n, ["id"])


def retained_alerts(alerts: DataFrame, since: Column | None = None) -> DataFrame:
    """The alert log after retention: all of it, or the alerts from a time on."""
    return alerts if since is None else alerts.filter(F.col("created_at") >= since)


def _alert(severity: Column, source: Column, message: Column, at: Column) -> list[Column]:
    key = F.md5(F.concat_ws("|", severity, source, message, at.cast("string")))
    return [
        key.alias("id"), severity.alias("severity"), source.alias("source"),
        message.alias("message"), F.lit(False).alias("acknowledged"), at.alias("created_at"),
    ]


def score_alerts(scores: DataFrame) -> DataFrame:
    s = F.col("overall_score")
    severity = F.when(s < GATE_MINIMUM, "CRITICAL").when(s < ALERT_BELOW, "WARNING")
    text = F.concat(F.col("table_name"), F.lit(" quality score: "), s, F.lit(" ("), grade(s), F.lit(")"))
    return scores.filter(s < ALERT_BELOW).select(*_alert(severity, F.lit("quality"), text, F.col("scored_at")))


def contract_alerts(summaries: DataFrame, at: Column) -> DataFrame:
    text = F.concat(
        F.lit("Contract violations in "), F.col("table_name"), F.lit(": "), F.col("violation_count"),
        F.lit(" violations ("), F.col("violation_rate_pct"), F.lit("% of rows)"),
    )
    broken = summaries.filter(~F.col("passed"))
    return broken.select(*_alert(F.lit("WARNING"), F.col("table_name"), text, at))


