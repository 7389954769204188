"""Row policies: who may read which rows, and which new rows may be written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """Rows belong to ``owner``, or to the owner of the ``parent`` row ``foreign_key`` points at.

    A table without a policy (None) is public.
    """

    owner: str | None = None
    parent: str | None = None
    foreign_key: str | None = None
    parent_key: str = "id"


# Owner, parent and foreign key of each table.
POLICIES: dict[str, Policy | None] = {
    "athletes": Policy(owner="id"),
    "workout_programs": Policy(owner="athlete_id"),
    "workouts": Policy(owner="athlete_id"),
    "workout_sets": Policy(parent="workouts", foreign_key="workout_id"),
    "personal_records": Policy(owner="athlete_id"),
    "body_metrics": Policy(owner="athlete_id"),
    "nutrition_logs": Policy(owner="athlete_id"),
    "cardio_sessions": Policy(owner="athlete_id"),
    "supplement_log": Policy(owner="athlete_id"),
    "workout_tag_assignments": Policy(parent="workouts", foreign_key="workout_id"),
    "exercises": None,
    "workout_tags": None,
}


def own_rows(df: DataFrame, owner: str, principal) -> DataFrame:
    return df.filter(F.col(owner) == F.lit(principal))


def through_parent(
    child: DataFrame, foreign_key: str, parent: DataFrame, owner: str, principal, parent_key: str = "id"
) -> DataFrame:
    owned = own_rows(parent, owner, principal).select(F.col(parent_key).alias(foreign_key))
    return child.join(owned, foreign_key, "left_semi")


def visible(tables: dict[str, DataFrame], name: str, principal, service_role: bool = False) -> DataFrame:
    """The rows of a table a principal may see. The service role sees everything."""
    policy = POLICIES[name]
    df = tables[name]
    if service_role or policy is None:
        return df
    if policy.owner:
        return own_rows(df, policy.owner, principal)
    above = POLICIES[policy.parent]
    return through_parent(
        df, policy.foreign_key, tables[policy.parent], above.owner, principal, policy.parent_key
    )


def check_writes(new_rows: DataFrame, allowed: Column) -> DataFrame:
    """New rows with ``_accepted``; a predicate that is null rejects."""
    return new_rows.withColumn("_accepted", F.coalesce(allowed, F.lit(False)))
