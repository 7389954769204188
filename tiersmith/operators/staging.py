"""Merge of a staged batch into the exercise library, with counts and an audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.functions.text import slug
from tiersmith.operators.cleaning import deduplicate

AUDIT_COLUMNS = [
    "event_type", "target_table", "target_record_id", "event_timestamp", "batch_id", "source_name",
    "old_values", "new_values", "change_reason", "triggered_by",
]


def staged_status(staged: DataFrame) -> DataFrame:
    """Staged rows with slug, status and error: a row without a usable name fails, and is kept."""
    key = slug(F.col("name"))
    usable = F.coalesce(key != "", F.lit(False))
    return staged.withColumns(
        {
            "slug": key,
            "processing_status": F.when(usable, "completed").otherwise("failed"),
            "error_message": F.when(~usable, F.lit("name gives no slug")),
        }
    )


def merge_exercises(exercises: DataFrame, staged: DataFrame, order_by: list[str]) -> DataFrame:
    """Library after the batch, plus per row ``_action``, its old values and the staged row count.

    Per slug the later staged row wins, non-null values first. One outer join decides insert,
    update or keep.
    """
    good = staged_status(staged).filter(F.col("processing_status") == "completed")
    order = F.struct(*[F.col(c) for c in order_by])
    late = good.groupBy("slug").agg(
        F.max_by("name", order).alias("_name"),
        # Later rows overwrite earlier ones only where they bring a value.
        F.max_by("description", F.when(F.col("description").isNotNull(), order)).alias("_text"),
        F.count("*").alias("_staged_rows"),
    )
    is_new = F.col("id").isNull()
    touched = F.col("_staged_rows").isNotNull()
    defaults = {
        "primary_muscle": "full_body", "exercise_type": "compound", "equipment": "none",
        "difficulty": "intermediate",
    }
    joined = exercises.join(late, "slug", "full_outer")
    return joined.select(
        F.coalesce("id", F.md5("slug")).alias("id"),
        "slug",
        F.coalesce("_name", "name").alias("name"),
        F.coalesce("_text", "instructions").alias("instructions"),
        *[F.when(is_new, v).otherwise(F.col(c)).alias(c) for c, v in defaults.items()],
        F.when(is_new, "INSERT").when(touched, "UPDATE").otherwise("KEEP").alias("_action"),
        F.when(~is_new, F.struct("name", "instructions")).alias("_old"),
        F.coalesce("_staged_rows", F.lit(0)).alias("_staged_rows"),
    )


def merge_counts(merged: DataFrame, staged: DataFrame) -> DataFrame:
    """inserted, updated, skipped, failed: a second staged row of a new slug counts as an update."""
    done = merged.agg(
        F.count_if(F.col("_action") == "INSERT").alias("inserted"),
        F.coalesce(
            F.sum(
                F.when(F.col("_action") == "UPDATE", F.col("_staged_rows"))
                .when(F.col("_action") == "INSERT", F.col("_staged_rows") - 1)
            ),
            F.lit(0),
        ).alias("updated"),
        F.lit(0).cast("bigint").alias("skipped"),
    )
    failed = staged_status(staged).agg(F.count_if(F.col("processing_status") == "failed").alias("failed"))
    both = done.unionByName(failed, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def audit_rows(
    changes: DataFrame, table_name: str, key: Column, action: Column, old: Column, new: Column,
    batch_id: str, source_name: str, at: Column,
) -> DataFrame:
    """Audit log rows for changed rows, old and new values as JSON."""
    reason = F.when(action == "INSERT", "New row from staging").otherwise("Staged row update")
    keep_nulls = {"ignoreNullFields": "false"}
    return changes.filter(action.isin("INSERT", "UPDATE", "DELETE", "MERGE", "SCD_CLOSE", "SCD_INSERT")).select(
        action.alias("event_type"),
        F.lit(table_name).alias("target_table"),
        key.cast("string").alias("target_record_id"),
        at.alias("event_timestamp"),
        F.lit(batch_id).alias("batch_id"),
        F.lit(source_name).alias("source_name"),
        F.to_json(old, keep_nulls).alias("old_values"),
        F.to_json(new, keep_nulls).alias("new_values"),
        reason.alias("change_reason"),
        F.lit("etl").alias("triggered_by"),
    )


def merge_audit(merged: DataFrame, batch_id: str, at: Column) -> DataFrame:
    return audit_rows(
        merged, "exercises", F.col("slug"), F.col("_action"), F.col("_old"),
        F.struct("name", "instructions"), batch_id, "exercise_api", at,
    )


def scd_audit(history: DataFrame, table_name: str, key: str, as_of: Column, cols: list[str], batch_id: str) -> DataFrame:
    """Audit rows of a history merge: versions closed and versions opened at ``as_of``."""
    closed = ~F.col("is_current") & (F.col("effective_to") == as_of)
    opened = F.col("is_current") & (F.col("effective_from") == as_of)
    action = F.when(closed, "SCD_CLOSE").when(opened, "SCD_INSERT")
    values = F.struct(*cols)
    return audit_rows(
        history, table_name, F.col(key), action, F.when(closed, values), F.when(opened, values),
        batch_id, "silver", as_of,
    )


def latest_staged(staged: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    return deduplicate(staged, [key], "last", order_by)
