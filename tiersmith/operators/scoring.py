"""Quality scores from validation and anomaly results, the grade and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.numeric import rounded

# Fixed values.
WEIGHTS = {"completeness": 0.30, "accuracy": 0.30, "consistency": 0.20, "timeliness": 0.20}
GRADES = [(95, "A+"), (90, "A"), (85, "B+"), (80, "B"), (70, "C"), (60, "D")]
GATE_MINIMUM = 50
ALERT_BELOW = 70


def grade(score: Column) -> Column:
    chain = F.when(score >= GRADES[0][0], GRADES[0][1])
    for bound, letter in GRADES[1:]:
        chain = chain.when(score >= bound, letter)
    return F.when(score.isNotNull(), chain.otherwise("F"))


def completeness(missing: Column, null_pct: Column) -> Column:
    deducted = F.least(missing * 15, F.lit(60)) + F.least(null_pct * 0.8, F.lit(40.0))
    return F.greatest(100.0 - deducted, F.lit(0.0))


def accuracy(failed: Column, checks: Column, anomalies: Column, checked: Column) -> Column:
    passing = 100.0 * F.coalesce(F.try_divide((checks - failed).cast("double"), checks), F.lit(1.0))
    rate = F.coalesce(F.try_divide(anomalies.cast("double"), checked), F.lit(0.0))
    return F.greatest(passing - F.least(rate * 100, F.lit(30.0)), F.lit(0.0))


def consistency(failed: Column, checks: Column) -> Column:
    return 100.0 * F.coalesce(F.try_divide((checks - failed).cast("double"), checks), F.lit(1.0))


def timeliness(stale: Column, age_hours: Column) -> Column:
    """100 when fresh or unchecked. A failed check without any date counts as the oldest."""
    late = (
        F.when(age_hours.isNull() | (age_hours > 168), 30.0).when(age_hours > 72, 60.0).otherwise(80.0)
    )
    return F.when(stale > 0, late).otherwise(100.0)


def rule_counts(results: DataFrame, by: list[str]) -> DataFrame:
    """Check counts per table (or any grouping) that the dimension scores are made of."""
    name, failed = F.col("rule_name"), ~F.col("passed")
    required = name.startswith("schema_required_column")
    fresh = name.startswith("freshness_")
    business = ~name.startswith("schema_") & ~fresh
    # A rule may count twice here: once as a type rule, once by its name.
    consistent = name.startswith("schema_type").cast("int") + (
        name.contains("in_set") | name.contains("valid_")
    ).cast("int")
    return results.groupBy(*by).agg(
        F.count("*").alias("total_checks"),
        F.count_if(failed).alias("failed_checks"),
        F.count_if(required & failed).alias("missing_columns"),
        F.count_if(business).alias("business_checks"),
        F.count_if(business & failed).alias("business_failed"),
        F.sum(consistent).alias("consistency_checks"),
        F.sum(F.when(failed, consistent).otherwise(0)).alias("consistency_failed"),
        F.count_if(fresh & failed).alias("stale"),
        F.max(F.when(fresh & failed, F.col("age_hours"))).alias("age_hours"),
    )


def score(results: DataFrame, anomalies: DataFrame | None, profile: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One score row per table.

    ``profile`` needs the grouping columns, ``null_pct`` and ``row_count``; ``anomalies`` the
    grouping columns, ``anomaly_count`` and ``total_count``.
    """
    by = by or ["table_name"]
    joined = profile.select(*by, "null_pct", "row_count").join(rule_counts(results, by), by, "left")
    if anomalies is not None:
        found = anomalies.groupBy(*by).agg(
            F.sum("anomaly_count").alias("anomalies_found"),
            # Values of columns with too few of them were not checked.
            F.sum(F.when(F.col("anomaly_count").isNotNull(), F.col("total_count"))).alias("values_checked"),
        )
        joined = joined.join(found, by, "left")
    else:
        none = F.lit(0).cast("bigint")
        joined = joined.withColumns({"anomalies_found": none, "values_checked": none})
    joined = joined.fillna(0, subset=[c for c in joined.columns if c not in (*by, "age_hours")])
    c = F.col
    parts = {
        "completeness": completeness(c("missing_columns"), c("null_pct")),
        "accuracy": accuracy(
            c("business_failed"), c("business_checks"), c("anomalies_found"), c("values_checked")
        ),
        "consistency": consistency(c("consistency_failed"), c("consistency_checks")),
        "timeliness": timeliness(c("stale"), c("age_hours")),
    }
    overall = sum((parts[k] * w for k, w in WEIGHTS.items()), F.lit(0.0))
    return joined.select(
        *by,
        rounded(overall, 2).alias("overall_score"),
        *[rounded(e, 2).alias(f"{k}_score") for k, e in parts.items()],
        grade(rounded(overall, 2)).alias("grade"),
        "row_count",
        "failed_checks",
        "total_checks",
        "anomalies_found",
    )


def gate(scores: DataFrame, minimum: float = GATE_MINIMUM) -> DataFrame:
    """Scores with the decision: below ``minimum`` blocks, below the alert bound only warns."""
    s = F.col("overall_score")
    return scores.withColumns(
        {
            "passes": s >= minimum,
            "alert": F.when(s < minimum, "CRITICAL").when(s < ALERT_BELOW, "WARNING"),
        }
    )


def gated(df: DataFrame, scores: DataFrame, by: list[str], minimum: float = GATE_MINIMUM) -> DataFrame:
    """Rows of the partitions whose score passes."""
    return df.join(gate(scores, minimum).filter("passes").select(*by), by, "left_semi")
