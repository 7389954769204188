"""Code lists and the column expressions that look them up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source code -> label.
MUSCLES = {
    1: "biceps", 2: "shoulders", 3: "abs", 4: "quads", 5: "chest", 6: "triceps", 7: "lats",
    8: "back", 9: "hamstrings", 10: "glutes", 11: "calves", 12: "traps", 13: "forearms",
    14: "obliques", 15: "hip_flexors", 16: "adductors", 17: "abductors", 18: "neck",
}
EQUIPMENT = {
    1: "barbell", 2: "smith_machine", 3: "dumbbell", 4: "machine", 5: "bodyweight",
    6: "pull_up_bar", 7: "none", 8: "cable", 9: "ez_bar", 10: "kettlebell",
}
EXERCISE_TYPES = {
    8: "compound", 9: "compound", 10: "compound", 11: "compound", 12: "compound",
    13: "compound", 14: "cardio", 15: "compound",
}
NUTRIENTS = {
    1003: "protein_g", 1004: "fats_g", 1005: "carbs_g", 1008: "calories", 1079: "fiber_g",
    2000: "sugar_g", 1093: "sodium_mg",
}
MOVEMENTS = {
    "chest": "upper_body_push", "shoulders": "upper_body_push", "triceps": "upper_body_push",
    "back": "upper_body_pull", "lats": "upper_body_pull", "biceps": "upper_body_pull",
    "traps": "upper_body_pull", "quads": "lower_body", "hamstrings": "lower_body",
    "glutes": "lower_body", "calves": "lower_body", "abs": "core", "obliques": "core",
    "full_body": "full_body",
}
# Muscle group, body region, target of compound movements.
MUSCLE_GROUPS = [
    ("chest", "upper_body", True), ("back", "upper_body", True), ("shoulders", "upper_body", True),
    ("biceps", "upper_body", False), ("triceps", "upper_body", False),
    ("forearms", "upper_body", False), ("quads", "lower_body", True),
    ("hamstrings", "lower_body", True), ("glutes", "lower_body", True),
    ("calves", "lower_body", False), ("abs", "core", False), ("obliques", "core", False),
    ("traps", "upper_body", False), ("lats", "upper_body", True),
    ("hip_flexors", "lower_body", False), ("adductors", "lower_body", False),
    ("abductors", "lower_body", False), ("neck", "upper_body", False),
    ("full_body", "full_body", True),
]
WORKOUT_STATUSES = ["completed", "skipped", "partial", "planned"]
MEAL_TYPES = ["breakfast", "lunch", "dinner", "pre_workout", "post_workout", "snack", "supplement"]


def labels(mapping: dict) -> Column:
    """The mapping as one literal map."""

    def text(x) -> str:
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "\\'") + "'"

    return F.expr("map(" + ", ".join(f"{text(k)}, {text(v)}" for k, v in mapping.items()) + ")")


def label_of(code: Column, mapping: dict, default: str) -> Column:
    return F.coalesce(F.try_element_at(labels(mapping), code), F.lit(default))


def first_label(codes: Column, mapping: dict, default: str) -> Column:
    """Label of the first code of an array; empty, null or unknown gives the default."""
    return label_of(F.get(codes, F.lit(0)), mapping, default)


def tail_labels(codes: Column, mapping: dict, default: str = "unknown") -> Column:
    """Labels of all codes but the first; an empty array when there are none."""
    tail = F.when(F.size(codes) > 1, F.slice(codes, F.lit(2), F.size(codes) - 1))
    mapped = F.transform(tail, lambda c: label_of(c, mapping, default))
    return F.coalesce(mapped, F.array().cast("array<string>"))


def last_by_id(items: Column, wanted: int, item_id, item_value) -> Column:
    """Value of the last array element whose id is ``wanted``."""
    hits = F.filter(items, lambda x: item_id(x) == wanted)
    return F.when(F.size(hits) > 0, item_value(F.element_at(hits, -1)))
