import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tiersmith.functions import numeric
from tiersmith.operators import anomalies, contracts, history, integrity, policies, profiling, scoring, search, validation
from tiersmith.operators.quantiles import value_counts


def now(text="2024-01-10 00:00:00"):
    return F.lit(text).cast("timestamp")


@pytest.fixture
def body(spark):
    data = [("a", "2024-01-08", 80.0, 12.0), ("a", "2024-01-07", 20.0, None), ("b", "2024-01-05", 400.0, 99.0)]
    return spark.createDataFrame(data, "athlete_id string, measured_at string, weight_kg double, body_fat_pct double").withColumn(
        "measured_at", F.col("measured_at").cast("timestamp")
    )


def by_rule(df):
    return {r.rule_name: r for r in df.collect()}


def test_rule_set(body):
    got = by_rule(validation.validate(body, "body_metrics", now=now()))
    assert (got["weight_reasonable"].failing_rows, got["weight_reasonable"].total_rows) == (2, 3)
    assert (got["body_fat_reasonable"].failing_rows, got["body_fat_reasonable"].total_rows) == (1, 2)
    assert not got["heart_rate_reasonable"].passed and "not found" in got["heart_rate_reasonable"].message
    assert got["schema_required_column_weight_kg"].passed and got["schema_type_measured_at"].passed
    assert got["freshness_body_metrics"].passed and got["freshness_body_metrics"].age_hours == 48.0
    late = by_rule(validation.validate(body, "body_metrics", now=now("2024-02-10 00:00:00")))
    assert not late["freshness_body_metrics"].passed


def test_rules_on_empty_table(body):
    got = by_rule(validation.validate(body.limit(0), "body_metrics", now=now()))
    assert got["weight_reasonable"].passed and not got["freshness_body_metrics"].passed
    assert got["freshness_body_metrics"].message == "No valid dates found for freshness check"


def test_open_bounds_samples_and_long_lists(spark, body):
    rules = [{"rule": "low", "column": "weight_kg", "check": "range", "min": 50}]
    many = rules + [{"rule": f"r{i}", "column": "weight_kg", "check": "max", "max": i} for i in range(250)]
    got = by_rule(validation.validate(body, "t", {"business_rules": {"t": many}}, now()))
    assert len(got) == 251 and got["low"].failing_rows == 1 and got["r100"].failing_rows == 1
    df = spark.createDataFrame([(x,) for x in "abcdefgab"] + [(None,)], "c string")
    rule = {"rule": "known", "column": "c", "check": "in_set", "allowed_values": ["a"]}
    assert validation.invalid_samples(df, [rule]).first().invalid_values == ["b", "c", "d", "e", "f"]
    with pytest.raises(KeyError):
        validation.validate(df, "unknown", {}, now())


def test_quoted_names_and_values(spark):
    df = spark.createDataFrame([("it's",)], "`odd name` string")
    rule = {"rule": "o'rule", "column": "odd name", "check": "in_set", "allowed_values": ["it's"], "description": 'a "b"'}
    got = validation.validate(df, "t", {"business_rules": {"t": [rule]}}, now()).first()
    assert got.passed and got.rule_name == "o'rule" and got.message == 'a "b"'


def test_anomalies(spark):
    data = [(float(i % 5), 1.0, None) for i in range(40)] + [(500.0, 1.0, None)]
    df = spark.createDataFrame(data, "x double, constant double, gone double")
    got = {(r.column, r.method): r for r in anomalies.detect(df).collect()}
    assert got["x", "z_score"].anomaly_count == 1 and got["x", "iqr"].anomaly_count == 1
    assert got["constant", "z_score"].anomaly_count == 0 and got["constant", "iqr"].anomaly_count == 0
    assert not any(c == "gone" for c, _ in got)
    few = anomalies.detect(df.limit(5)).collect()
    assert few and {(r.status, r.anomaly_count, r.anomaly_pct) for r in few} == {("too few values", None, None)}

    flagged = anomalies.flagged_rows(df.withColumn("id", F.col("x")), ["id"], ["x"]).collect()
    assert [(r.id, r.value) for r in flagged] == [(500.0, 500.0)]


@pytest.mark.parametrize(
    "score, grade", [(95.0, "A+"), (94.99, "A"), (90.0, "A"), (85.0, "B+"), (80.0, "B"), (70.0, "C"), (60.0, "D"), (59.9, "F")]
)
def test_grades(spark, score, grade):
    assert spark.range(1).select(scoring.grade(F.lit(score)).alias("g")).first().g == grade
    assert sum(scoring.WEIGHTS.values()) == pytest.approx(1.0)


def test_score_and_gate(spark, body):
    results = validation.validate(body, "body_metrics", now=now())
    profile = profiling.null_share(body, []).withColumn("table_name", F.lit("body_metrics"))
    s = scoring.score(results, None, profile).first()
    # 1 of 12 cells is null; all three value rules fail; types hold; data is fresh.
    assert (s.completeness_score, s.accuracy_score, s.consistency_score, s.timeliness_score) == (93.34, 0.0, 100.0, 100.0)
    assert s.overall_score == 68.0 and s.grade == "D"
    scores = spark.createDataFrame([("a", 49.9), ("b", 50.0), ("c", 70.0)], "k string, overall_score double")
    assert rows(scoring.gate(scores), "k", "passes", "alert") == [("a", False, "CRITICAL"), ("b", True, "WARNING"), ("c", True, None)]
    data = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert rows(scoring.gated(data, scores, ["k"])) == [("b", 2)]


def test_timeliness_ladder(spark):
    ages = [(1, 200.0, 30.0), (1, 100.0, 60.0), (1, 50.0, 80.0), (1, None, 30.0), (0, None, 100.0)]
    df = spark.createDataFrame(ages, "stale int, age double, want double")
    assert all(r.want == r.t for r in df.withColumn("t", scoring.timeliness(F.col("stale"), F.col("age"))).collect())


def test_contracts(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "lunch", 500.0), (2, None, "brunch", -1.0), (3, "2024-01-01", None, 9000.0)],
        "id int, log_date string, meal_type string, calories double",
    )
    found = rows(contracts.violations(df, "nutrition_logs", ["id"]), "id", "field", "message")
    assert found == [
        (2, "calories", "Less than 0"), (2, "log_date", "Field required"), (2, "meal_type", "Value not allowed"),
        (3, "calories", "Greater than 5000"), (3, "meal_type", "Field required"),
    ]
    s = contracts.summary(df, "nutrition_logs").first()
    assert (s.total_rows, s.valid_rows, s.violation_count, s.violation_rate_pct, s.passed) == (3, 1, 5, 66.67, False)
    good, bad = contracts.quarantine(df, contracts.contract("nutrition_logs"))
    assert good.count() + bad.count() == df.count() and rows(good, "id") == [(1,)]
    empty = contracts.summary(df.limit(0), "nutrition_logs").first()
    assert empty.passed and empty.violation_rate_pct == 0.0
    with pytest.raises(KeyError):
        contracts.summary(df, "unknown")
    assert contracts.sample_rows(df, 2).count() == 2


def test_text_in_a_number_column(spark):
    df = spark.createDataFrame([(1, "heavy"), (2, "80")], "id int, weight_kg string")
    assert rows(contracts.violations(df, "body_metrics", ["id"]), "id", "message") == [(1, "Not a number")]


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, "x" * 100, None, True), (2, "x" * 100, None, False), (2, "x" * 100, None, False), (3, "", None, None)],
        "n int, s string, e string, b boolean",
    )
    t = profiling.table_profile(df, "t").first()
    assert (t.row_count, t.column_count, t.duplicate_rows, t.empty_columns, t.columns_with_nulls, t.null_cells) == (4, 4, 1, 1, 2, 5)
    cols = {r.column: r for r in profiling.column_profile(df).collect()}
    assert (cols["s"].unique_count, cols["n"].unique_count, cols["e"].null_pct) == (2, 3, 100.0)
    warned = {(r.column, r.severity) for r in profiling.profile_warnings(profiling.column_profile(df)).collect()}
    assert ("e", "CRITICAL") in warned
    assert profiling.boolean_profile(df).first().false_count == 2
    top = profiling.top_values(df, ["n", "s"], 1).collect()
    assert {(r.column, r.n) for r in top} == {("n", 2), ("s", 3)}


def test_integrity(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 1)], "c int, fk int")
    assert rows(integrity.orphans(child, "fk", parent, "id"), "c") == [(11,)]
    gone = parent.filter("id = 1")
    assert rows(integrity.cascade_delete(child, "fk", gone, "id"), "c") == [(11,), (12,)]
    assert rows(integrity.set_null_delete(child, "fk", gone, "id")) == sorted([(10, None), (11, 3), (12, None), (13, None)], key=repr)
    assert rows(integrity.duplicate_keys(child, ["fk"])) == [(1, 2)]


def test_policies(spark):
    tables = {
        "workouts": spark.createDataFrame([(1, "me"), (2, "you")], "id int, athlete_id string"),
        "workout_sets": spark.createDataFrame([(1, 5), (2, 6)], "workout_id int, reps int"),
        "exercises": spark.createDataFrame([(1,)], "id int"),
    }
    assert rows(policies.visible(tables, "workouts", "me")) == [(1, "me")]
    assert rows(policies.visible(tables, "workout_sets", "me")) == [(1, 5)]
    assert policies.visible(tables, "exercises", "nobody").count() == 1
    assert policies.visible(tables, "workout_sets", "me", service_role=True).count() == 2


def test_search(spark):
    df = spark.createDataFrame([(1, "The Bench press bench"), (2, "benchpress"), (3, "press the BENCH, now")], "id int, t string")
    got = {r.id: (r.hits, r.words) for r in search.search(df, "press of BENCH", ["t"]).collect()}
    assert got == {1: (3, 3), 3: (2, 3)}
    index = search.inverted_index(df, "id", ["t"])
    assert rows(search.search_index(index, "id", "press of BENCH"), "id", "hits") == [(1, 3), (3, 2)]
    assert search.search(df, "the of", ["t"]).count() == 0


def test_history(spark):
    scores = spark.createDataFrame(
        [("a", 1, 40.0), ("a", 2, 65.0), ("b", 1, 90.0)], "table_name string, d int, overall_score double"
    ).withColumn("scored_at", F.timestamp_seconds(F.col("d") * 86400))
    assert rows(history.score_delta(scores)) == [("a", 65.0, 40.0, 25.0), ("b", 90.0, 90.0, 0.0)]
    assert rows(history.latest_scores(scores), "table_name", "overall_score") == [("a", 65.0), ("b", 90.0)]
    assert history.average_of_latest(scores).first().grade == "C"
    alerts = history.score_alerts(scores)
    assert rows(alerts, "severity") == [("CRITICAL",), ("WARNING",)]
    assert rows(history.alert_counts(alerts)) == [("CRITICAL", 1), ("INFO", 0), ("WARNING", 1)]
    assert history.retained_alerts(alerts).count() == alerts.count()
    assert history.run_kpis(scores.limit(0).select(F.lit("x").alias("status"), F.lit(1).alias("rows_processed"))).first().success_rate == 0.0


def test_figures_of_large_and_small_values(spark):
    values = {"large": [1e15 + i % 7 for i in range(400)], "small": [1e-5] * 99 + [2e-5], "huge": [1e200, 2e200] * 6}
    rows = [(c, float(v)) for c, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "c string, v double")
    for c, vs in values.items():
        own = df.filter(F.col("c") == c)
        assert own.agg(numeric.total("v"), numeric.mean("v")).first()[0] == pytest.approx(math.fsum(vs), rel=1e-12)
        stats = {r.method: r for r in anomalies.detect(own, ["v"]).collect()}
        if c != "huge":
            assert stats["z_score"].anomaly_count == sum(abs(v - np.mean(vs)) / np.std(vs, ddof=1) > 3 for v in vs)
    large = anomalies.column_stats(value_counts(df.filter("c = 'large'").withColumnRenamed("v", "value"), ["c"]), ["c"], 1.5, 10).first()
    assert large["mean"] == pytest.approx(np.mean(values["large"]), abs=0.3)
    assert large["std"] == pytest.approx(np.std([i % 7 for i in range(400)], ddof=1), rel=1e-3)
    mixed = spark.createDataFrame([(2e14,), (5.0,), (None,)], "v double")
    assert mixed.agg(numeric.total("v"), numeric.mean("v"), numeric.rounded(F.max("v") * 1e20, 2)).first() == (2e14 + 5, (2e14 + 5) / 2, 2e34)


def test_search_stems_words_of_any_script(spark):
    texts = [(1, "running runs quickly"), (2, "Übung macht den Meister"), (3, "bung hole"), (4, "Привет, мир"), (5, "hoped; flies")]
    df = spark.createDataFrame(texts, "id int, t string")
    index = search.inverted_index(df, "id", ["t"])
    for query, want in {"run": {1}, "quick runs": {1}, "Übung": {2}, "bung": {3}, "МИР": {4}, "hope fly": {5}, "hop": {5}}.items():
        found = {r.id: (r.hits, r.words, r.score) for r in search.search(df, query, ["t"]).collect()}
        assert set(found) == want
        assert {r.id: (r.hits, r.words, r.score) for r in search.search_index(index, "id", query).collect()} == found
